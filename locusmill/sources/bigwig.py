"""BigWig score tracks as a data source: the index says which blocks a query needs, tasks read those ranges alone.

A BigWig file holds compressed blocks of intervals and a tree over them. Planning walks down the tree
through the nodes that meet one of the regions, and deals the blocks it finds, neighbours together, to
partitions of about `partition_bytes`. A task reads its ranges (neighbours by one read), inflates block by block
and hands Arrow batches on. So neither the file's size nor a task's memory is bound to the other, and a
query over few positions reads few blocks of a file of any size.

Both byte orders are read, blocks with and without compression, and the three kinds of blocks (bed
graph, variable and fixed steps).
"""

from __future__ import annotations

import bisect
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .ranged import RangedFile, files_of, write_bytes

MAGIC, CHROM_MAGIC, INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
PARTITION_BYTES = 16 << 20
#: Blocks of a partition closer than this are one read.
GAP = 1 << 16
SCHEMA = "chromosome string, start int, end int, score double, ordinal long"


class Regions:
    """Regions by chromosome (1-based, bounds included), for tests whether a stretch meets any of them."""

    def __init__(self, regions: list[tuple[str, int, int]]):
        self.by: dict[str, list[list[int]]] = {}
        for name, start, end in sorted(map(tuple, regions)):
            own = self.by.setdefault(name, [])
            if own and start <= own[-1][1] + 1:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([start, end])

    def meets(self, name: str, start: int, end: int) -> bool:
        """Whether the bases from `start` (counted from 0) to before `end` meet a region."""
        own = self.by.get(name, ())
        at = bisect.bisect_right(own, [end, float("inf")]) - 1
        return at >= 0 and own[at][1] > start


@dataclass
class Header:
    order: str
    names: dict[int, str]
    index: int
    packed: bool


def read_header(f: RangedFile) -> Header:
    head = f.read(0, 64)
    order = next((o for o in "<>" if len(head) == 64 and struct.unpack_from(o + "I", head)[0] == MAGIC), None)
    if order is None:
        raise ValueError(f"{f.path} is not a BigWig file")
    _, _, chroms, _, index = struct.unpack_from(order + "HHQQQ", head, 4)
    return Header(order, dict(_chromosomes(f, chroms, order)), index + 48, struct.unpack_from(order + "I", head, 52)[0] > 0)


def _chromosomes(f: RangedFile, at: int, order: str) -> Iterator[tuple[int, str]]:
    magic, _, key = struct.unpack(order + "III", f.read(at, 12))
    if magic != CHROM_MAGIC:
        raise ValueError(f"{f.path} has no tree of chromosomes")
    todo = [at + 32]
    while todo:
        node = todo.pop()
        leaf, _, n = struct.unpack(order + "BBH", f.read(node, 4))
        items = f.read(node + 4, n * (key + 8))
        for i in range(n):
            own = i * (key + 8)
            if leaf:
                yield struct.unpack_from(order + "I", items, own + key)[0], items[own : own + key].rstrip(b"\0").decode()
            else:
                todo.append(struct.unpack_from(order + "Q", items, own + key)[0])


def blocks_of(f: RangedFile, head: Header, regions: Regions | None) -> Iterator[tuple[int, int]]:
    """(offset, size) of the blocks that meet a region (or of all), in the order of the index; nodes that meet none are not read."""

    def wanted(first: int, start: int, last: int, end: int) -> bool:
        if regions is None:
            return True
        if first == last:
            return regions.meets(head.names[first], start, end)
        whole = float("inf")
        return any(regions.meets(head.names[c], start if c == first else 0, end if c == last else whole) for c in range(first, last + 1) if head.names.get(c) in regions.by)

    todo = [head.index]
    while todo:
        node = todo.pop()
        leaf, _, n = struct.unpack(head.order + "BBH", f.read(node, 4))
        step, form = (32, "IIIIQQ") if leaf else (24, "IIIIQ")
        items = [struct.unpack_from(head.order + form, part) for part in _pieces(f.read(node + 4, n * step), step)]
        some = [x for x in items if wanted(*x[:4])]
        if leaf:
            yield from ((x[4], x[5]) for x in some)
        else:
            todo += [x[4] for x in reversed(some)]


def _pieces(data: bytes, step: int) -> Iterator[bytes]:
    for i in range(0, len(data), step):
        yield data[i : i + step]


def intervals(block: bytes, head: Header) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(chromosome, starts from 0, ends, scores) of an inflated block."""
    o = head.order
    chrom, start, _, step, span, kind, _, n = struct.unpack_from(o + "IIIIIBBH", block)
    fields = {1: [("a", o + "u4"), ("b", o + "u4"), ("v", o + "f4")], 2: [("a", o + "u4"), ("v", o + "f4")], 3: [("v", o + "f4")]}
    rows = np.frombuffer(block, np.dtype(fields[kind]), n, 24)
    a = rows["a"].astype(np.int64) if kind != 3 else start + np.arange(n, dtype=np.int64) * step
    return head.names[chrom], a, rows["b"].astype(np.int64) if kind == 1 else a + span, rows["v"].astype(float)


@dataclass
class Blocks(InputPartition):
    path: str
    head: Header
    blocks: list[tuple[int, int]]


class BigWigReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.regions = json.loads(options["regions"]) if "regions" in options else None
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Blocks]:
        regions = None if self.regions is None else Regions(self.regions)
        out = []
        for path in files_of(self.path, ".bw"):
            with RangedFile(path) as f:
                head, held, n = read_header(f), [], 0
                for block in blocks_of(f, head, regions):
                    held.append(block)
                    n += block[1]
                    if n >= self.size:
                        out.append(Blocks(path, head, held))
                        held, n = [], 0
                if held:
                    out.append(Blocks(path, head, held))
        return out or [Blocks("", None, [])]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        if not partition.blocks:
            return
        with RangedFile(partition.path) as f:
            for offset, data in _together(f, partition.blocks):
                name, a, b, v = intervals(zlib.decompress(data) if partition.head.packed else data, partition.head)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(a), pa.string()), pa.array(a + 1, pa.int32()), pa.array(b, pa.int32()), pa.array(v, pa.float64()),
                    pa.array((offset << 16) + np.arange(len(a)), pa.int64()),
                ], names=["chromosome", "start", "end", "score", "ordinal"])


def _together(f: RangedFile, blocks: list[tuple[int, int]], most: int = 4 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of each block; blocks that lie close are read at once, up to `most` bytes."""
    i = 0
    while i < len(blocks):
        first, end, k = blocks[i][0], sum(blocks[i]), i + 1
        while k < len(blocks) and 0 <= blocks[k][0] - end <= GAP and sum(blocks[k]) - first <= most:
            end, k = sum(blocks[k]), k + 1
        data = f.read(first, end - first)
        for offset, size in blocks[i:k]:
            yield offset, data[offset - first : offset - first + size]
        i = k


class BigWigSource(DataSource):
    """Options: path (a file, or a folder of files that end in .bw), regions (JSON list of [chromosome, start, end]), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BigWigReader:
        return BigWigReader(self.options)


def read_bigwig(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(chromosome, start, end, score, ordinal), 1-based closed intervals; with `regions`, of the blocks that meet one of them."""
    spark.dataSource.register(BigWigSource)
    reader = spark.read.format("bigwig").option("partitionBytes", partition_bytes)
    if regions is not None:
        reader = reader.option("regions", json.dumps([list(r) for r in regions]))
    return reader.load(path)


def regions_of(points: DataFrame, chrom: str = "chromosome", pos: str = "position", width: int = 100_000) -> list[tuple[str, int, int]]:
    """Stretches of `width` bases that hold a point, for `read_bigwig`: at most the genome's length / width of them come to the driver."""
    bins = points.where(F.col(chrom).isNotNull()).select(F.col(chrom).alias("c"), F.floor((F.col(pos) - 1) / width).alias("b")).where("b >= 0").distinct()
    return sorted((r["c"], r["b"] * width + 1, (r["b"] + 1) * width) for r in bins.toLocalIterator())


# ---------------------------------------------------------------- write
def file_parts(blocks: list[tuple[int, int, int, bytes]], names: list[tuple[str, int]], order: str = "<", fan: int = 256) -> Iterator[bytes]:
    """The bytes of a file of `blocks` (chromosome number, start, end, compressed bed graph), ordered; names: (chromosome, length)."""
    key = max((len(n.encode()) for n, _ in names), default=1)
    chroms = struct.pack(order + "IIIIQQ", CHROM_MAGIC, max(1, len(names)), key, 8, len(names), 0) + struct.pack(order + "BBH", 1, 0, len(names))
    chroms += b"".join(n.encode().ljust(key, b"\0") + struct.pack(order + "II", i, size) for i, (n, size) in enumerate(names))
    data = 64 + len(chroms)
    index = data + 8 + sum(len(b[3]) for b in blocks)
    yield struct.pack(order + "IHHQQQHHQQIQ", MAGIC, 4, 0, 64, data, index, 0, 0, 0, 0, 1 << 15, 0) + chroms + struct.pack(order + "Q", len(blocks))
    at, leaves = data + 8, []
    for chrom, start, end, packed in blocks:
        yield packed
        leaves.append((chrom, start, chrom, end, at, len(packed)))
        at += len(packed)
    yield struct.pack(order + "IIQIIIIQII", INDEX_MAGIC, fan, len(leaves), *(_span(leaves) if leaves else (0, 0, 0, 0)), index, fan, 0)
    # Levels from the root down; each node lists up to `fan` of the level below it.
    levels = [[leaves[i : i + fan] for i in range(0, len(leaves), fan)] or [[]]]
    while len(levels[0]) > 1:
        spans = [_span(node) for node in levels[0]]
        levels.insert(0, [spans[i : i + fan] for i in range(0, len(spans), fan)])
    at = index + 48
    for depth, level in enumerate(levels):
        last = depth + 1 == len(levels)
        at += sum(4 + len(node) * (32 if last else 24) for node in level)
        below, child = at, 0
        for node in level:
            yield struct.pack(order + "BBH", last, 0, len(node))
            for item in node:
                if last:
                    yield struct.pack(order + "IIIIQQ", *item)
                else:
                    yield struct.pack(order + "IIIIQ", *item, below)
                    below += 4 + len(levels[depth + 1][child]) * (32 if depth + 2 == len(levels) else 24)
                    child += 1
    yield struct.pack(order + "I", MAGIC)


def _span(items: list[tuple]) -> tuple[int, int, int, int]:
    first, last = min(x[:2] for x in items), max(x[2:4] for x in items)
    return (*first, *last)


def write_bigwig(df: DataFrame, path: str, per_block: int = 1024, order: str = "<") -> DataFrame:
    """Writes (chromosome, start, end, score), 1-based closed intervals, as a folder of BigWig files; (file, n, bytes) of each.

    Rows are ranged over the cluster by chromosome and start, and each task writes one file of its range,
    of which it holds the compressed blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names: dict[str, list[int]] = {}
        blocks, n = [], 0
        for name, a, b, v in _by_chromosome(batches, per_block):
            own = names.setdefault(name, [len(names), 0])
            own[1] = max(own[1], int(b.max()))
            rows = np.empty(len(a), [("a", order + "u4"), ("b", order + "u4"), ("v", order + "f4")])
            rows["a"], rows["b"], rows["v"] = a - 1, b, v
            head = struct.pack(order + "IIIIIBBH", own[0], int(a[0]) - 1, int(b.max()), 0, 0, 1, 0, len(a))
            blocks.append((own[0], int(a[0]) - 1, int(b.max()), zlib.compress(head + rows.tobytes())))
            n += len(a)
        if blocks:
            name = f"part-{TaskContext.get().partitionId():05d}.bw"
            size = write_bytes(f"{path}/{name}", file_parts(blocks, [(k, x[1]) for k, x in names.items()], order))
            yield pa.RecordBatch.from_pydict({"file": [name], "n": [n], "bytes": [size]})

    rows = df.select("chromosome", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("score").cast("double").alias("score"))
    rows = rows.repartitionByRange("chromosome", "start").sortWithinPartitions("chromosome", "start", "end")
    return rows.mapInArrow(run, "file string, n long, bytes long")


def _by_chromosome(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of up to `size` rows of one chromosome, of ordered batches."""
    for batch in batches:
        names = np.array(batch.column(0).to_pylist(), object)
        a, b, v = (batch.column(i).to_numpy() for i in (1, 2, 3))
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for x, y in zip(cuts, cuts[1:]):
            for i in range(x, y, size):
                k = min(i + size, y)
                yield names[i], a[i:k], b[i:k], v[i:k]
