"""Plain files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder's path in it; no scheme means local."""
    folder = re.sub(r"^file:/(?!/)", "file:///", folder)
    if re.match(r"[a-z][a-z0-9+.-]*://", folder):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


class NewFile:
    """A file that appears under its name only when it is complete.

    Its name holds a random part: a task that is run again writes another file, and
    only the one whose rows Spark keeps is ever read.
    """

    def __init__(self, folder: str, prefix: str, suffix: str):
        self.fs, path = store(folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
        self.path, self.size = f"{path}/{self.name}", 0
        self.out = self.fs.open_output_stream(f"{self.path}.part")

    def write(self, data) -> int:
        """Where in the file `data` begins."""
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def close(self):
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)


class Reader:
    """Range reads that keep the last file open."""

    def __init__(self, folder: str):
        self.fs, self.folder = store(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.folder}/{name}")
        return self.file.read_at(length, offset)

    def close(self):
        if self.file is not None:
            self.file.close()
        self.name = self.file = None
