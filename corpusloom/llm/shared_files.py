"""Files that tasks write to the shared folder: temporary name first, then moved into place."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a path without a scheme is a local one."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@contextmanager
def committed(path: str) -> Iterator[fs.FileSystem]:
    """A sink for ``path`` that appears under that name only when it is complete.

    A retried or speculative task writes a temporary file of its own; the last move wins, and
    all attempts have the same bytes. What a lost task leaves behind is in no manifest.
    """
    system, place = located(path)
    folder, _, name = place.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/_draft-{uuid.uuid4().hex}-{name}"
    sink = system.open_output_stream(draft, compression=None)
    try:
        yield sink
    except BaseException:
        sink.close()
        system.delete_file(draft)
        raise
    sink.close()
    system.move(draft, place)
