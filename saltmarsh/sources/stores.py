"""Files on any store that Arrow reaches, from the driver and from Python tasks."""

from __future__ import annotations

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path or URI, and the path in it; a path without a scheme is on the local disk."""
    if path.startswith("file:") or "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def text_of(path: str) -> str | None:
    """A small file's text; null if it isn't there."""
    store, at = opened(path)
    if store.get_file_info(at).type != fs.FileType.File:
        return None
    with store.open_input_stream(at) as f:
        return f.read().decode()
