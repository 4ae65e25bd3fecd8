"""Term patterns: regular expressions of wildcards, and the character runs a pattern cannot do without."""

from __future__ import annotations

import re

START, END = "\x02", "\x03"


def wildcard_regex(pattern: str) -> str:
    """``*`` any run, ``?`` any one character, backslash takes the next literally."""
    out, chars = "", iter(pattern)
    for ch in chars:
        if ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        else:
            literal = next(chars, "\\") if ch == "\\" else ch
            out += literal if literal.isalnum() else rf"\x{{{ord(literal):x}}}"
    return rf"(?s)\A{out}\z"


def lowered_pattern(pattern: str) -> str:
    """The pattern with its literal letters lowercased.

    Escapes (``\\D``, ``\\p{Lu}``) and what opens a group (``(?U)``, ``(?<Name>``) stay as they are,
    text between ``\\Q`` and ``\\E`` is literal.
    """
    piece = r"\\Q(.*?)(?:\\E|\Z)|\\[pP]\{[^}]*\}|\\k<[^>]*>|\\.|\(\?(?:<\w+>|[a-zA-Z-]*)|[^\\(]+|\("
    out = ""
    for match in re.finditer(piece, pattern, re.DOTALL):
        if match[1] is not None:
            out += rf"\Q{match[1].lower()}\E"
        else:
            out += match[0] if match[0][0] in "\\(" else match[0].lower()
    return out


def _longest_grams(pieces: list[str]) -> list[str]:
    """The runs of three characters of all pieces, or else of two, or else single characters."""
    for n in (3, 2, 1):
        found = sorted({p[i : i + n] for p in pieces for i in range(len(p) - n + 1)} - {START, END})
        if found:
            return found
    return []


def wildcard_grams(pattern: str) -> list[str]:
    """Character runs that every match of a wildcard pattern has; none for a pattern without a literal."""
    pieces, chars = [START], iter(pattern)
    for ch in chars:
        if ch in "*?":
            pieces.append("")
        else:
            pieces[-1] += next(chars, "\\") if ch == "\\" else ch
    pieces[-1] += END
    return _longest_grams(pieces)


def regex_grams(pattern: str) -> list[str]:
    """Character runs that every match of a regular expression has, as far as they are plain to see.

    Groups, classes and escapes end a run; alternatives outside of groups, flags and quotations give none.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return []
    pieces, at, single = [START], 0, False
    while at < len(pattern):
        ch = pattern[at]
        if ch == "|":
            return []
        if ch in "([":
            end = _closing(pattern, at)
            if end < 0:
                return []
            pieces.append("")
            at, single = end, False
        elif ch == "\\":
            following = pattern[at + 1 : at + 2]
            if following.isalnum() or not following:
                skip = re.match(r"\\[pPxNk][{<][^}>]*[}>]|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\0[0-7]{1,3}|\\c.|\\.|\\", pattern[at:], re.DOTALL)
                pieces.append("")
                at, single = at + len(skip[0]) - 1, False
            else:
                pieces[-1] += following
                at, single = at + 1, True
        elif ch in "*?{":
            if single:
                pieces[-1] = pieces[-1][:-1]
            pieces.append("")
            single = False
            if ch == "{":
                at = pattern.find("}", at)
                if at < 0:
                    return []
        elif ch == "+":
            pieces.append("")
            single = False
        elif ch in ".^$":
            pieces.append("")
            single = False
        else:
            pieces[-1] += ch.lower()
            single = True
        at += 1
    pieces[-1] += END
    return _longest_grams(pieces)


def _closing(pattern: str, at: int) -> int:
    """Index of what closes the group or class at ``at``, or -1."""
    opening, depth = pattern[at], 0
    while at < len(pattern):
        if pattern[at] == "\\":
            at += 1
        elif pattern[at] == "[" and opening == "(":
            at = _closing(pattern, at)
            if at < 0:
                return -1
        elif pattern[at] == opening:
            depth += 1
        elif pattern[at] == (")" if opening == "(" else "]"):
            depth -= 1
            if depth == 0:
                return at
        at += 1
    return -1
