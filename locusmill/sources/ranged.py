"""Files that are read by ranges of bytes, in tasks: indexed binary formats of which a query needs few parts.

Local paths are opened as they are, any other by its scheme through Arrow's file systems (hdfs, s3, gs),
so neither a whole file nor a JVM is needed in a task.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from urllib.parse import unquote, urlsplit

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    url = urlsplit(path)
    if url.scheme in ("", "file"):
        return fs.LocalFileSystem(), os.path.abspath(unquote(url.path) if url.scheme else path)
    return fs.FileSystem.from_uri(path)


def files_of(path: str, suffix: str) -> list[str]:
    """The file itself, or the files with a suffix in a folder, in order of their names."""
    store, at = file_system(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    names = sorted(f.path[len(at) :].strip("/") for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not f.base_name.startswith(("_", ".")))
    return [f"{path.rstrip('/')}/{n}" for n in names]


class RangedFile:
    """One open file; `read(offset, size)` gives those bytes (fewer at its end), `n_read` counts them."""

    def __init__(self, path: str):
        store, at = file_system(path)
        self.path, self.file, self.n_read = path, store.open_input_file(at), 0

    def __enter__(self) -> RangedFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def size(self) -> int:
        return self.file.size()

    def read(self, offset: int, size: int) -> bytes:
        data = self.file.read_at(max(0, min(size, self.file.size() - offset)), offset)
        self.n_read += len(data)
        return data


def write_bytes(path: str, parts: Iterable[bytes]) -> int:
    """Writes one file under a name of its own first, so that a task run again leaves a whole file; how many bytes."""
    store, at = file_system(path)
    store.create_dir(os.path.dirname(at), recursive=True)
    n = 0
    with store.open_output_stream(f"{at}.{os.getpid()}.part") as out:
        for part in parts:
            out.write(part)
            n += len(part)
    store.move(f"{at}.{os.getpid()}.part", at)
    return n
