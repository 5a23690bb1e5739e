"""Files in the shared folder, written and read inside tasks (any store that
``pyarrow.fs`` opens; memory-mapped where the store is a mounted path)."""

from __future__ import annotations

import os
import re

import numpy as np
from pyarrow import fs


def open_fs(path: str):
    """(file system, path in it) of a URI or plain path."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def make_dir(path: str) -> None:
    f, p = open_fs(path)
    f.create_dir(p, recursive=True)


def writer(path: str):
    f, p = open_fs(path)
    return f.open_output_stream(p)


def reader(path: str):
    f, p = open_fs(path)
    return f.open_input_file(p)


def mapped(path: str, dtype: str) -> np.ndarray:
    """The file as an array; a memory map where the store is mounted."""
    f, p = open_fs(path)
    if isinstance(f, fs.LocalFileSystem):
        return np.memmap(p, dtype, "r") if os.path.getsize(p) else np.zeros(0, dtype)
    with f.open_input_file(p) as src:
        return np.frombuffer(src.read(), dtype)
