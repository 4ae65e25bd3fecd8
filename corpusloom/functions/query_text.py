"""Query texts as clause trees.

``+x`` must hold, ``-x`` and ``!x`` must not, others may; ``"x y"~2`` is a phrase with slop, ``( )`` groups clauses,
``x*`` and ``x?y`` are patterns, ``x~1`` a fuzzy word, ``[x to y]`` a range of terms, ``field:`` chooses a field,
``^2`` multiplies a score, ``&&`` makes both neighbours required, ``||`` stands for nothing, a backslash takes the next character
literally. Texts are lowercased first, so the words *and*, *or* and *not* are words like others.

A tree is two arrays. Leaves are ``(kind, field, text, low, high, number)``; nodes come children first, the root last, as
``(leaf, must, should, must_not, boost)`` with numbers of nodes.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F

LEAF = "kind:string,field:string,text:string,low:string,high:string,number:double"
NODE = "leaf:int,must:array<int>,should:array<int>,must_not:array<int>,boost:double"
TREE = f"struct<leaves:array<struct<{LEAF}>>,nodes:array<struct<{NODE}>>,error:string>"

DEFAULT_EDITS = 2
_SPECIAL = r'\s()"\[\]{}^~\\:'
_TOKEN = re.compile(
    rf"""(?P<space>\s+)|(?P<both>&&)|(?P<either>\|\|)|(?P<sign>[+\-!])(?=\S)|(?P<open>\()|(?P<close>\))
    |"(?P<phrase>(?:[^"\\]|\\.)*)"|[\[{{]\s*(?P<low>\S+)\s+to\s+(?P<high>[^\s\]}}]+)\s*[\]}}]
    |(?P<field>[a-z_][\w.\-]*):(?=\S)|\^(?P<boost>\d+(?:\.\d+)?)|~(?P<near>\d+(?:\.\d+)?)?
    |(?P<term>(?:\\.|[^{_SPECIAL}+\-!])(?:\\.|[^{_SPECIAL}])*)""",
    re.VERBOSE | re.DOTALL,
)


class _Reader:
    def __init__(self, text: str):
        self.leaves: list[dict] = []
        self.nodes: list[dict] = []
        self.tokens = []
        at = 0
        while at < len(text):
            match = _TOKEN.match(text, at)
            if not match:
                raise ValueError(f"cannot read {text[at : at + 10]!r}")
            kind = match.lastgroup or ("near" if match[0][0] == "~" else "term")
            if kind != "space":
                self.tokens.append(("range" if kind == "high" else kind, match))
            at = match.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][0] if self.at < len(self.tokens) else None

    def take(self) -> re.Match:
        self.at += 1
        return self.tokens[self.at - 1][1]

    def node(self, leaf: int | None = None, **parts) -> int:
        self.nodes.append({"leaf": leaf, "must": [], "should": [], "must_not": [], "boost": 1.0} | parts)
        return len(self.nodes) - 1

    def leaf(self, kind: str, field: str | None, **parts) -> int:
        empty = {"text": None, "low": None, "high": None, "number": 0.0}
        self.leaves.append({"kind": kind, "field": field} | empty | parts)
        return self.node(len(self.leaves) - 1)

    def clause(self, field: str | None) -> int:
        kind = self.peek()
        if kind == "field":
            return self.clause(self.take()["field"])
        if kind == "open":
            self.take()
            node = self.group(field, nested=True)
        elif kind == "phrase":
            node = self.leaf("phrase", field, text=_unescaped(self.take()["phrase"]))
            if self.peek() == "near":
                self.leaves[-1]["number"] = float(self.take()["near"] or 0)
        elif kind == "range":
            match = self.take()
            node = self.leaf("range", field, low=_open(match["low"]), high=_open(match["high"]))
        elif kind == "term":
            text = self.take()["term"]
            pattern = re.search(r"(?<!\\)(?:\\\\)*[*?]", text)
            node = self.leaf("pattern", field, text=text) if pattern else self.leaf("word", field, text=_unescaped(text))
            if self.peek() == "near":
                edits = self.take()["near"]
                self.leaves[-1].update(kind="fuzzy", number=float(DEFAULT_EDITS if edits is None else edits))
        else:
            raise ValueError(f"a clause is missing before {self.tokens[self.at][1][0]!r}" if kind else "a clause is missing")
        if self.peek() == "boost":
            self.nodes[node]["boost"] = float(self.take()["boost"])
        return node

    def group(self, field: str | None, nested: bool) -> int:
        parts: dict[str, list[int]] = {"must": [], "should": [], "must_not": []}
        required = False
        while (kind := self.peek()) is not None and kind != "close":
            if kind in ("both", "either"):
                self.take()
                if kind == "both":
                    required = True
                    if parts["should"] and parts["should"][-1] == len(self.nodes) - 1:
                        parts["must"].append(parts["should"].pop())
                continue
            sign = self.take()["sign"] if kind == "sign" else ""
            node = self.clause(field)
            occur = {"+": "must", "-": "must_not", "!": "must_not"}.get(sign, "must" if required else "should")
            parts[occur].append(node)
            required = False
        if nested != (self.peek() == "close"):
            raise ValueError("brackets do not match")
        if nested:
            self.take()
        if not any(parts.values()):
            raise ValueError("a group is empty")
        return self.node(**parts)


def _unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _open(bound: str) -> str | None:
    return None if bound == "*" else _unescaped(bound)


def read_query(text: str | None) -> dict:
    """``leaves``, ``nodes`` and ``error`` of a lowercased query text; with an error there are no nodes."""
    try:
        reader = _Reader(text or "")
        reader.group(None, nested=False)
        return {"leaves": reader.leaves, "nodes": reader.nodes, "error": None}
    except ValueError as unreadable:
        return {"leaves": [], "nodes": [], "error": str(unreadable)}


def _read_column(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_query(t) for t in texts], columns=["leaves", "nodes", "error"])


def query_tree(text: Column) -> Column:
    """The tree of a query text as a struct column."""
    return F.pandas_udf(_read_column, TREE)(F.lower(text))


def read_line(line: str) -> tuple[str, list]:
    """Type and arguments of a line ``type field text``, as the search functions take them.

    A range is ``low,high``; a disjunction is ``multiplier; field field; words``.
    """
    kind, _, rest = line.strip().partition(" ")
    kind, rest = kind.lower(), rest.strip()
    if kind == "matchall":
        return kind, []
    field, _, text = rest.partition(" ")
    text = text.lower()
    if not field or not text.strip():
        raise ValueError(f"{kind} needs a field and a text")
    if kind == "termrange":
        low, comma, high = text.partition(",")
        if not comma:
            raise ValueError("a range is low,high")
        return kind, [field, low, high.split(",")[0]]
    if kind == "disjunction":
        fields, semicolon, words = text.strip().partition(";")
        if not semicolon:
            raise ValueError("a disjunction is multiplier; fields; words")
        return kind, [fields.split(), words.strip(), float(field.replace(";", ""))]
    return kind, [field, text]
