"""Binary files in the shared folder, written and read by tasks.

A task writes under a name nobody else uses and hands on one manifest row when the file is closed.
Only files named in a manifest count, so a task that is lost or runs twice leaves at most an unused file.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file: local, HDFS or an object store."""
    return fs.FileSystem.from_uri(uri)


class Writer:
    """One new file in `folder`; counts the bytes written."""

    def __init__(self, folder: str, label: str):
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name = f"{label}-{uuid.uuid4().hex}"
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.size = 0
        self._out = system.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()


def reader(uri: str) -> pa.NativeFile:
    """Random access to a file."""
    system, path = opened(uri)
    return system.open_input_file(path)


def stream(uri: str) -> pa.NativeFile:
    """Front-to-back access to a file."""
    system, path = opened(uri)
    return system.open_input_stream(path, compression=None, buffer_size=1 << 20)
