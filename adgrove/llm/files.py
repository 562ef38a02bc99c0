"""Files that tasks write to, and read from, a folder all machines share.

A task names its files after itself and a random suffix, and reports them as rows. Only reported files are read, so
what a lost or repeated attempt left behind is never seen.
"""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or plain path."""
    if "://" in uri or uri.startswith("file:"):
        scheme, _, rest = uri.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def write_new(folder: str, stem: str, suffix: str, data: bytes) -> str:
    """Path of a new file with these bytes."""
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    system, path = locate(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)
    return uri


def read_all(uri: str) -> bytes:
    system, path = locate(uri)
    with system.open_input_stream(path, compression=None) as data:
        return data.read()


def read_span(uri: str, start: int, size: int) -> bytes:
    """Bytes ``start`` to ``start + size`` without reading the rest."""
    system, path = locate(uri)
    with system.open_input_file(path) as data:
        return data.read_at(size, start)


def file_size(uri: str) -> int:
    system, path = locate(uri)
    return system.get_file_info(path).size
