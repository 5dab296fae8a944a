"""Files of shared stores as tasks open them, by Arrow's file systems."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote


def store_of(uri: str):
    """(Arrow file system, path in it) of a file or folder, whose name may hold any character, as Spark gives it; one without a scheme is local."""
    from pyarrow import fs

    uri = re.sub("^file:/+", "file:///", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(quote(uri, safe=":/" if uri.startswith("file:") else ":/@?&="))


def opened_by_tasks(uri: str) -> bool:
    """Whether Arrow has a file system for a file or folder, so that tasks can list and open it."""
    try:
        store_of(uri)
    except (ValueError, NotImplementedError, OSError):
        return False
    return True


def entries_of(store, folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(name, whether it is a folder, bytes, milliseconds of its last change) of what is directly in a folder; local ones are never whole in memory."""
    from pyarrow import fs

    if not isinstance(store, fs.LocalFileSystem):
        for f in store.get_file_info(fs.FileSelector(folder)):
            yield f.base_name, f.type == fs.FileType.Directory, f.size or 0, (f.mtime_ns or 0) // 1_000_000
        return
    with os.scandir(folder) as found:
        for f in found:
            try:
                told = f.stat()
            except FileNotFoundError:  # it went meanwhile, or is a link to nothing
                continue
            yield f.name, f.is_dir(), told.st_size, told.st_mtime_ns // 1_000_000


def read_text(uri: str) -> str:
    """A small file as text; ``FileNotFoundError`` if it isn't there."""
    store, path = store_of(uri)
    with store.open_input_stream(path, compression=None) as f:
        return f.read().decode("utf-8")


def write_text(uri: str, text: str) -> None:
    store, path = store_of(uri)
    with store.open_output_stream(path, compression=None) as f:
        f.write(text.encode("utf-8"))
