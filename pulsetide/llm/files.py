"""Plain files in the shared folder, written and read inside tasks through any file system pyarrow knows."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:"):
        uri = uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = file_system(uri)
    system.create_dir(path, recursive=True)


class Writing:
    """A file that appears under its name only when whole, so a lost or repeated task leaves no part of one."""

    def __init__(self, uri: str):
        self.system, self.path = file_system(uri)
        self.draft = f"{self.path}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.out = self.system.open_output_stream(self.draft)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.system.move(self.draft, self.path)
        else:
            self.system.delete_file(self.draft)


def mapped(uri: str, kind: str) -> np.ndarray:
    """A file's values, memory-mapped where the shared folder is mounted."""
    system, path = file_system(uri)
    if isinstance(system, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


def read_range(uri: str, start: int, size: int) -> bytes:
    system, path = file_system(uri)
    with system.open_input_file(path) as file:
        return file.read_at(min(size, max(0, file.size() - start)), start)


def whole(uri: str) -> bytes:
    system, path = file_system(uri)
    with system.open_input_file(path) as file:
        return file.read()
