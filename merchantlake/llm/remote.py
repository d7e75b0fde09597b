"""Byte ranges of files in the shared folder, read and written inside tasks."""

from __future__ import annotations

import re
from functools import lru_cache

from pyarrow import fs


@lru_cache(maxsize=8)
def _file_system(root: str):
    return fs.FileSystem.from_uri(root)[0]


def locate(path: str):
    """The file system that holds ``path``, and the path on it. One slash or three after the scheme mean the same."""
    uri = re.sub(r"^file:/+", "file:///", path)
    root = re.match(r"[a-z0-9+]+://[^/]*/|/", uri)
    if root is None:
        raise ValueError(f"not an absolute path: {path}")
    system = _file_system(root[0])
    inside = re.sub(r"^file://", "", uri) if uri.startswith("file:") else uri
    if not inside.startswith("/"):
        inside = fs.FileSystem.from_uri(uri)[1]
    return system, inside
