"""File access of Python data sources, on any file system pyarrow knows by its URI."""

from __future__ import annotations

from pyarrow import fs


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path inside it) of a URI or a plain local path."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound
