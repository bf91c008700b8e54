"""Files of a store opened inside tasks, through ``pyarrow.fs``."""

from __future__ import annotations

import re

_SAME = {"s3a": "s3", "s3n": "s3"}


def split_uri(uri: str) -> tuple[str, str]:
    """(scheme, the rest as Hadoop prints it): ``file:/a b`` -> ``("file", "/a b")``."""
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(.*)$", uri)
    return (m[1].lower(), m[2]) if m else ("file", uri)


def open_store(uri: str):
    """(file system, path in it) of a path as Hadoop prints it; ``None`` where pyarrow has no client for the scheme."""
    from pyarrow import ArrowException, fs
    scheme, rest = split_uri(uri)
    if scheme == "file":
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", rest)
    authority, _, path = rest.lstrip("/").partition("/")
    try:
        system, root = fs.FileSystem.from_uri(f"{_SAME.get(scheme, scheme)}://{authority}/")
    except (ArrowException, OSError, ValueError):
        return None
    return system, f"{root.rstrip('/')}/{path}".rstrip("/")
