"""Bulk copy of files by tasks: thousands of result shards from one store to another.

The files of a manifest are dealt to tasks by their sizes, so that each has about as many bytes; a task copies
its files one by one as streams, tries again where one fails, and gives a row per file with its bytes and
checksum. A file comes to its place whole or not at all, so a task that is run again, or a whole copy, is
safe. A missing file is a row with an error, not the end of the copy.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sweep import running
from .ranged import RangedFile, file_system, write_bytes

CHUNK = 4 << 20
RESULT = "source string, target string, bytes long, crc32 long, tries int, error string"


def sized(paths: DataFrame) -> DataFrame:
    """(source, bytes) of each path of `paths` (source); bytes is null where there is no file. Sizes are asked for by tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for path in names:
                store, at = file_system(path)
                sizes.append(store.get_file_info(at).size)
            yield pa.RecordBatch.from_pydict({"source": pa.array(names, pa.string()), "bytes": pa.array(sizes, pa.int64())})

    return paths.select("source").where("source is not null").distinct().mapInArrow(run, "source string, bytes long")


def copy_file(source: str, target: str, tries: int = 3, wait: float = 0.5) -> tuple[int | None, int | None, int, str | None]:
    """(bytes, crc32, tries, error) of one copy; what arrived is read back against the checksum of what was sent."""
    for k in range(1, tries + 1):
        try:
            crc = 0
            with RangedFile(source) as f:
                size = f.size()

                def chunks(f=f, size=size) -> Iterator[bytes]:
                    nonlocal crc
                    for at in range(0, size, CHUNK):
                        data = f.read(at, CHUNK)
                        crc = zlib.crc32(data, crc)
                        yield data

                write_bytes(target, chunks())
            there = 0
            with RangedFile(target) as f:
                for at in range(0, f.size(), CHUNK):
                    there = zlib.crc32(f.read(at, CHUNK), there)
            if there != crc:
                raise OSError(f"{target} has checksum {there}, not {crc}")
            return size, crc, k, None
        except FileNotFoundError as e:
            return None, None, k, str(e)[:500]
        except OSError as e:
            error = str(e)[:500]
            if k < tries:
                time.sleep(wait * k)
    return None, None, tries, error


def copy_files(pairs: DataFrame, tasks: int = 64, tries: int = 3) -> DataFrame:
    """(source, target, bytes, crc32, tries, error) of each row of `pairs` (source, target); an action on the result copies.

    Each of `tasks` groups has about as many bytes as any other; targets have to differ.
    """
    rows = running(pairs.join(sized(pairs), "source").withColumn("bytes", F.coalesce("bytes", F.lit(0))), [], ["source", "target"], "bytes", "sum", "__before")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    # Files in order, cut where their bytes so far pass another share of all.
    dealt = rows.withColumn("__group", F.floor(F.col("__before") * tasks / F.lit(total + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b, *copy_file(a, b, tries)) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            names = [c.split(" ")[0] for c in RESULT.split(", ")]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return dealt.repartitionByRange(tasks, "__group").select("source", "target").mapInArrow(run, RESULT)
