"""Files that tasks write themselves, on any file system that a path names."""

from __future__ import annotations

import re


def filesystem(path: str):
    """The (Arrow) file system of a path or URI, and the path within it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def open_output(path: str):
    """A new binary file and its folders; the stream must be closed."""
    fs, inner = filesystem(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(inner, compression=None)
