"""Files that tasks write and read in the shared folder, other than Spark's tables."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyarrow import fs


def place(uri: str):
    """(file system, path) of a shared folder given as URI or absolute path."""
    return fs.FileSystem.from_uri(uri if urlsplit(uri).scheme else f"file://{uri}")


def write_whole(uri: str, pieces) -> int:
    """Write a file under a name of its own, then give it its name: a reader never sees a
    part of it, and a second attempt of the task replaces it."""
    system, path = place(uri)
    folder = path.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(hidden, compression=None) as out:
        for piece in pieces:
            out.write(piece)
            size += len(piece)
    system.move(hidden, path)
    return size
