"""Binary files in the shared folder, written and read inside tasks.

A task writes each file under a name of its own and returns the name in its
rows, so files of failed or repeated attempts are never referred to.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file URI."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def write_bytes(uri: str, data: bytes) -> None:
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_file(path) as f:
        return f.read()
