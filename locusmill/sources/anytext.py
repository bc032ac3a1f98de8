"""Lines of text files of any kind, told by their first bytes and not by their names: plain, gzip, block-gzip, also mixed in one folder.

Plain and block-gzip files are read by ranges of bytes in parallel. An ordinary gzip file can only be
inflated from its start, so it is one task's, which inflates it member by member from an open stream in
bounded memory, whatever the size of the file or of a member.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from .blockgzip import BlockGzipReader, Stretch, _batches, member_size
from .ranged import RangedFile, files_of

PARTITION_BYTES = 64 << 20
READ_BYTES = 1 << 20


def kind_of(f: RangedFile) -> str:
    """plain, gzip or blockgzip."""
    head = f.read(0, 64)
    return "plain" if head[:2] != b"\x1f\x8b" else "blockgzip" if member_size(head) else "gzip"


def lines_of(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Lines of consecutive pieces, without their ends (LF or CR LF)."""
    rest: list[bytes] = []
    for piece in pieces:
        first, *more = piece.split(b"\n")
        rest.append(first)
        for line in more:
            yield b"".join(rest).removesuffix(b"\r")
            rest = [line]
    if last := b"".join(rest):
        yield last.removesuffix(b"\r")


def inflate(f: RangedFile) -> Iterator[bytes]:
    """The text of a gzip file of any number of members, in pieces; zeros after the last member are padding."""
    at, total = 0, f.size()
    z, data = zlib.decompressobj(31), b""
    while at < total or data:
        if not data:
            data = f.read(at, READ_BYTES)
            at += len(data)
        piece = z.decompress(data, READ_BYTES)
        if piece:
            yield piece
        if z.eof:
            data = z.unused_data or f.read(at, READ_BYTES)
            at += 0 if z.unused_data else len(data)
            z = zlib.decompressobj(31)
            if not data.strip(b"\0"):
                return
        else:
            data = z.unconsumed_tail
    if not z.eof and total:
        raise ValueError(f"{f.path} ends within a member")


class AnyTextReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Stretch]:
        out = []
        for path in (x for p in self.paths for x in files_of(p, "")):
            with RangedFile(path) as f:
                total = f.size()
                step = max(1, total) if kind_of(f) == "gzip" else self.size
                out += [Stretch(path, None, at, min(at + step, total)) for at in range(0, total, step)]
        return out or [Stretch("", None)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with RangedFile(partition.path) as f:
            kind = kind_of(f)
            if kind == "gzip":
                lines = lines_of(inflate(f))
            elif kind == "blockgzip":
                lines = (x.removesuffix(b"\r") for x in BlockGzipReader({"path": partition.path, "header": "false"})._range(f, partition))
            else:
                lines = self._plain(f, partition)
            yield from _batches(lines)

    def _plain(self, f: RangedFile, own: Stretch) -> Iterator[bytes]:
        """The lines that start in the range: from after the first end of a line at or behind the byte before it."""

        def pieces(at: int) -> Iterator[bytes]:
            while data := f.read(at, READ_BYTES):
                yield data
                at += len(data)

        at = own.start
        if at:
            for piece in pieces(at - 1):
                end = piece.find(b"\n")
                if end >= 0:
                    at += end
                    break
                at += len(piece)
        for line, after in _with_ends(pieces(at), at):
            if after[0] >= own.end:
                return
            yield line


def _with_ends(pieces: Iterable[bytes], at: int) -> Iterator[tuple[bytes, tuple[int, int]]]:
    """Lines with the places (start, end) they have in the file."""
    start, rest = at, []
    for piece in pieces:
        first, *more = piece.split(b"\n")
        rest.append(first)
        for line in more:
            whole = b"".join(rest)
            yield whole.removesuffix(b"\r"), (start, start + len(whole) + 1)
            start += len(whole) + 1
            rest = [line]
    if last := b"".join(rest):
        yield last.removesuffix(b"\r"), (start, start + len(last))


class AnyTextSource(DataSource):
    """Options: path (a file or a folder) or paths (a JSON list of them), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "anytext"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> AnyTextReader:
        return AnyTextReader(self.options)


def read_any_text(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """A row per line as `value`. path: a file, a folder or a pattern."""
    spark.dataSource.register(AnyTextSource)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    if not found:
        raise FileNotFoundError(path)
    paths = json.dumps([s.getPath().toUri().toString() for s in found])
    return spark.read.format("anytext").option("paths", paths).option("partitionBytes", partition_bytes).load()
