"""Plain binary files in the cluster's shared folder, from inside tasks.

Spark's writers make tables; the archive and token formats here are files of
their own. A task writes each under a name no other attempt uses and returns a
row that names it. Only rows of successful attempts reach the manifest table,
so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyarrow import fs


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a ``file:``, ``s3:``, ``gs:`` or ``hdfs:`` URI (or plain path), and the path in it."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def fresh_name(folder: str, suffix: str) -> str:
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    """A new file, with its folder."""
    system, path = file_system(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A file to read at any place."""
    system, path = file_system(uri)
    return system.open_input_file(path)
