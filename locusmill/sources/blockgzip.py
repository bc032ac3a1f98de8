"""Block-gzip text with a position index: dosage matrices of any size, of which a query reads the blocks of its regions.

Block-gzip is a gzip file of small members, each with its own size in its header, so a reader may start at
any of them. Two ways of reading follow:

* with regions, planning asks the index (.tbi: bins of positions and a linear index over them) for the
  stretches of the file that can hold them, and tasks read these stretches alone;
* without, a file is cut into ranges of bytes. A task looks for the first member of its range, leaves the line
  that runs into it to the task before, and reads on to the end of its own last line.

Files are written the same way: rows are ranged by position over the cluster, each task writes one file of its
range with its index, so that a folder of such files is one table. Both are the formats of common tools.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.keys import normalize_chr, prefixed_chr, variant_id
from .bigwig import Regions
from .ranged import RangedFile, files_of, write_bytes

#: Text of a member at most, the window of the linear index as a shift, and the empty member that ends a file.
BLOCK_TEXT, WINDOW = 65_280, 14
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
PARTITION_BYTES = 32 << 20
READ_BYTES = 1 << 20
#: Levels of bins: the shift of positions and the first bin's number, from the smallest bins to the whole chromosome.
LEVELS = [(14 + 3 * k, ((1 << 3 * (5 - k)) - 1) // 7) for k in range(6)]


# ---------------------------------------------------------------- members
def pack_member(text: bytes) -> bytes:
    """One member of at most BLOCK_TEXT bytes of text."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(text) + z.flush()
    if len(body) + 26 > 1 << 16:  # text that does not compress
        z = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = z.compress(text) + z.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(text), len(text))


def member_size(data: bytes, at: int = 0) -> int | None:
    """The size of the member whose header starts at `at`; None if none does."""
    if len(data) < at + 18 or data[at : at + 4] != b"\x1f\x8b\x08\x04":
        return None
    extra, i = struct.unpack_from("<H", data, at + 10)[0], at + 12
    end = i + extra
    while i + 4 <= min(end, len(data)):
        size = struct.unpack_from("<H", data, i + 2)[0]
        if data[i : i + 2] == b"BC" and size == 2 and i + 6 <= len(data):
            return struct.unpack_from("<H", data, i + 4)[0] + 1
        i += 4 + size
    return None


def members(f: RangedFile, at: int) -> Iterator[tuple[int, int, bytes]]:
    """(offset, size, text) of the members from the one at `at` on."""
    data, base, total = b"", at, f.size()
    while at < total:
        size = member_size(data, at - base) if at - base < len(data) else None
        if size is None or at - base + size > len(data):
            data, base = f.read(at, READ_BYTES), at
            size = member_size(data)
            if size is None or size > len(data):
                raise ValueError(f"{f.path} has no whole member at byte {at}")
        yield at, size, zlib.decompress(data[at - base : at - base + size], 31)
        at += size


def first_member(f: RangedFile, at: int) -> int:
    """Where the first member at or after byte `at` starts: a header that is followed by another one or by the end. The file's size if none does."""
    total = f.size()
    while at < total:
        data = f.read(at, READ_BYTES)
        i = data.find(b"\x1f\x8b\x08\x04")
        while i >= 0:
            size = member_size(data, i) if i + 18 <= len(data) else member_size(f.read(at + i, 64))
            if size and (at + i + size == total or (at + i + size < total and member_size(f.read(at + i + size, 64)))):
                return at + i
            i = data.find(b"\x1f\x8b\x08\x04", i + 1)
        at += max(1, len(data) - 3)
    return total


# ---------------------------------------------------------------- index
def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds the positions from `start` (counted from 0) to before `end`."""
    for shift, first in LEVELS:
        if start >> shift == (end - 1) >> shift:
            return first + (start >> shift)
    return 0


def bins_of(start: int, end: int) -> set[int]:
    """All bins that may hold something of the positions from `start` to before `end`."""
    return {first + b for shift, first in LEVELS for b in range(start >> shift, ((end - 1) >> shift) + 1)}


@dataclass
class Index:
    """Where lines of a chromosome's positions are: chunks of virtual offsets (member << 16 | place in its text) by bin, and the first one per window."""

    bins: dict[str, dict[int, list[tuple[int, int]]]] = field(default_factory=dict)
    windows: dict[str, list[int]] = field(default_factory=dict)
    header_lines: int = 0

    def add(self, name: str, position: int, first: int, after: int) -> None:
        """A line of one position (1-based) that lies from virtual offset `first` to before `after`; lines come in the order of the file."""
        chunks = self.bins.setdefault(name, {}).setdefault(bin_of(position - 1, position), [])
        if chunks and chunks[-1][1] == first:
            chunks[-1] = (chunks[-1][0], after)
        else:
            chunks.append((first, after))
        windows = self.windows.setdefault(name, [])
        while len(windows) <= (position - 1) >> WINDOW:
            windows.append(first)

    def chunks(self, regions: Regions) -> list[tuple[int, int]]:
        """Disjoint stretches that hold all lines of the regions."""
        found = []
        for name, own in regions.by.items():
            bins, windows = self.bins.get(name), self.windows.get(name, [])
            if not bins:
                continue
            for start, end in own:
                least = windows[min((start - 1) >> WINDOW, len(windows) - 1)] if windows and start > 0 else 0
                last = len(windows) << WINDOW
                wanted = bins_of(max(0, start - 1), max(1, min(end, last))) if last >= start else ()
                found += [c for b in (wanted if len(wanted) < len(bins) else bins) if b in wanted for c in bins.get(b, ()) if c[1] > least]
        out: list[tuple[int, int]] = []
        for a, b in sorted(found):
            # Neighbours stay apart, so that a long region can be dealt to several tasks.
            if out and a < out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], b))
            else:
                out.append((a, b))
        return out

    def parts(self) -> Iterator[bytes]:
        """The index as the members of its file."""
        names = list(self.bins)
        label = b"".join(n.encode() + b"\0" for n in names)
        out = [b"TBI\1" + struct.pack("<8i", len(names), 0, 1, 2, 0, ord("#"), self.header_lines, len(label)) + label]
        for n in names:
            out.append(struct.pack("<i", len(self.bins[n])))
            for b, chunks in self.bins[n].items():
                out.append(struct.pack("<Ii", b, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            out.append(struct.pack("<i", len(self.windows[n])) + struct.pack(f"<{len(self.windows[n])}Q", *self.windows[n]))
        data = b"".join(out)
        yield from (pack_member(data[i : i + BLOCK_TEXT]) for i in range(0, len(data), BLOCK_TEXT))
        yield END

    @classmethod
    def read(cls, f: RangedFile) -> Index:
        data = b"".join(text for *_, text in members(f, 0))
        magic, n_names = struct.unpack_from("<4si", data)
        if magic != b"TBI\1":
            raise ValueError(f"{f.path} is not an index of positions")
        skip, size = struct.unpack_from("<2i", data, 28)
        names = [x.decode() for x in data[36 : 36 + size].split(b"\0")[:n_names]]
        at, out = 36 + size, cls(header_lines=skip)
        for name in names:
            bins = out.bins[name] = {}
            (n_bins,) = struct.unpack_from("<i", data, at)
            at += 4
            for _ in range(n_bins):
                b, n = struct.unpack_from("<Ii", data, at)
                bins[b] = list(struct.iter_unpack("<QQ", data[at + 8 : at + 8 + 16 * n]))
                at += 8 + 16 * n
            bins.pop(37450, None)  # a summary, not a bin
            (n,) = struct.unpack_from("<i", data, at)
            out.windows[name] = list(struct.unpack_from(f"<{n}Q", data, at + 4))
            at += 4 + 8 * n
        return out


# ---------------------------------------------------------------- read
@dataclass
class Stretch(InputPartition):
    """Chunks of virtual offsets, or (without) a range of bytes."""

    path: str
    chunks: list[tuple[int, int]] | None
    start: int = 0
    end: int = 0


class BlockGzipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.header = options.get("header", "true") == "true"
        self.regions = json.loads(options["regions"]) if "regions" in options else None
        self.size = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Stretch]:
        out = []
        for path in files_of(self.path, ".gz"):
            if self.regions is None:
                with RangedFile(path) as f:
                    total = f.size()
                out += [Stretch(path, None, at, min(at + self.size, total)) for at in range(0, total, self.size)]
                continue
            with RangedFile(f"{path}.tbi") as f:
                index = Index.read(f)
            held: list[tuple[int, int]] = []
            for chunk in index.chunks(Regions(self.regions)):
                if held and sum(b - a for a, b in held) + chunk[1] - chunk[0] > self.size << 16:
                    out.append(Stretch(path, held))
                    held = []
                if held and held[-1][1] == chunk[0]:
                    held[-1] = (held[-1][0], chunk[1])
                else:
                    held.append(chunk)
            if held:
                out.append(Stretch(path, held))
        return out or [Stretch("", [])]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with RangedFile(partition.path) as f:
            lines = self._range(f, partition) if partition.chunks is None else self._chunks(f, partition.chunks)
            yield from _batches(lines)

    def _chunks(self, f: RangedFile, chunks: list[tuple[int, int]]) -> Iterator[bytes]:
        regions = Regions(self.regions)
        for first, after in chunks:
            rest = b""
            for at, _, text in members(f, first >> 16):
                start = first & 0xFFFF if at == first >> 16 else 0
                end = after & 0xFFFF if at == after >> 16 else len(text) if at < after >> 16 else 0
                rest += text[start:end]
                *lines, rest = rest.split(b"\n")
                for line in lines:
                    name, position = line.split(b"\t", 2)[:2]
                    if regions.meets(name.decode(), int(position) - 1, int(position)):
                        yield line
                if at >= after >> 16:
                    break

    def _range(self, f: RangedFile, own: Stretch) -> Iterator[bytes]:
        at = first_member(f, own.start)
        if at >= own.end:
            return
        rest, skip = b"", own.start > 0 or self.header
        for offset, _, text in members(f, at):
            rest += text
            *lines, rest = rest.split(b"\n")
            past = offset >= own.end
            if lines and skip:  # the header, or the line that the range before reads to its end
                lines, skip = lines[1:], False
                if past:
                    return
            # Of what starts beyond the range, only the line that began in it or right at its end is its own.
            yield from lines[:1] if past else lines
            if past and lines:
                return
        if rest and not skip:
            yield rest


def _batches(lines: Iterable[bytes], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for line in lines:
        held.append(line)
        n += len(line)
        if n >= size:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], names=["value"])
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], names=["value"])


class BlockGzipSource(DataSource):
    """Options: path (a file, or a folder of files that end in .gz), header, regions (JSON list of [chromosome, start, end]; needs an index), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "blockgzip"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(self.options)


def read_lines(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None, header: bool = True, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The lines as `value`, without header; with `regions`, those whose first column and second (a position) lie in one."""
    spark.dataSource.register(BlockGzipSource)
    reader = spark.read.format("blockgzip").option("header", str(header).lower()).option("partitionBytes", partition_bytes)
    if regions is not None:
        reader = reader.option("regions", json.dumps([list(r) for r in regions]))
    return reader.load(path)


def header_of(path: str) -> list[str]:
    """The columns that the first line names."""
    head = b""
    with RangedFile(files_of(path, ".gz")[0]) as f:
        for *_, text in members(f, 0):
            head += text
            if b"\n" in head:
                break
    return head.split(b"\n", 1)[0].decode().split("\t")


def read_dosages(spark: SparkSession, path: str, regions: list[tuple[str, int, int]] | None = None, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """CHROM, POS, REF, ALT, then samples: variant_id, chromosome, position, ref, alt and the array `dosage` in file order, as `tables.dosages` gives them."""
    cells = F.split("value", "\t")
    cell = lambda i: F.get(cells, F.lit(i))
    bare = prefixed_chr(normalize_chr(cell(0)))
    position = cell(1).cast("int")
    dosage = F.transform(F.slice(cells, 5, len(header_of(path)) - 4), lambda x: x.try_cast("double"))
    if regions is not None:  # files name chromosomes with and without chr
        regions = [(name, a, b) for c, a, b in regions for name in (c.removeprefix("chr"), f"chr{c.removeprefix('chr')}")]
    lines = read_lines(spark, path, regions, True, partition_bytes)
    return lines.select(variant_id(bare, position, cell(2), cell(3)).alias("variant_id"), bare.alias("chromosome"), position.alias("position"), cell(2).alias("ref"), cell(3).alias("alt"), dosage.alias("dosage"))


# ---------------------------------------------------------------- write
def file_members(lines: Iterable[tuple[str, int, bytes]], header: bytes, index: Index) -> Iterator[bytes]:
    """The members of a file of ordered lines (chromosome, position, line), with `index` filled in."""
    at, held, n, places = 0, [], 0, []

    def close() -> bytes:
        nonlocal at, held, n, places
        member = pack_member(b"".join(held))
        for name, position, start, end in places:
            first, after = at << 16 | start, at << 16 | end
            # What ends a member is where the next one starts.
            index.add(name, position, first, after if end < n else (at + len(member)) << 16)
        at, held, n, places = at + len(member), [], 0, []
        return member

    def long(text: bytes) -> Iterator[bytes]:
        """Members of a line of many samples."""
        nonlocal at
        for i in range(0, len(text), BLOCK_TEXT):
            member = pack_member(text[i : i + BLOCK_TEXT])
            at += len(member)
            yield member

    if header:
        index.header_lines = 1
        if len(header) >= BLOCK_TEXT:
            yield from long(header + b"\n")
        else:
            held, n = [header + b"\n"], len(header) + 1
    for name, position, line in lines:
        line += b"\n"
        if n and n + len(line) > BLOCK_TEXT:
            yield close()
        if len(line) > BLOCK_TEXT:
            start = at << 16
            yield from long(line)
            index.add(name, position, start, at << 16)
            continue
        places.append((name, position, n, n + len(line)))
        held.append(line)
        n += len(line)
    if held:
        yield close()
    yield END


def write_lines(df: DataFrame, path: str, chromosome: str, position: str, line: Column, header: str = "") -> DataFrame:
    """Writes the text `line` of each row as a folder of block-gzip files with indexes; (file, n, bytes) of each. An action on the result writes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index, n = Index(), 0

        def lines() -> Iterator[tuple[str, int, bytes]]:
            nonlocal n
            for batch in batches:
                for name, at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    n += 1
                    yield name, at, text.encode()

        name = f"part-{TaskContext.get().partitionId():05d}.tsv.gz"
        size = write_bytes(f"{path}/{name}", file_members(lines(), header.encode(), index))
        write_bytes(f"{path}/{name}.tbi", index.parts())
        yield pa.RecordBatch.from_pydict({"file": [name], "n": [n], "bytes": [size]})

    rows = df.select(F.col(chromosome).alias("c"), F.col(position).cast("long").alias("p"), line.alias("t"))
    rows = rows.repartitionByRange("c", "p").sortWithinPartitions("c", "p", "t")
    return rows.mapInArrow(run, "file string, n long, bytes long")


def write_dosages(dosages: DataFrame, path: str, samples: list[str]) -> DataFrame:
    """Dosages (chromosome, position, ref, alt, dosage array in the order of `samples`) as text with an index; missing ones are NA."""
    cells = F.transform("dosage", lambda x: F.coalesce(x.cast("string"), F.lit("NA")))
    line = F.concat_ws("\t", "chromosome", F.col("position").cast("string"), "ref", "alt", cells)
    return write_lines(dosages, path, "chromosome", "position", line, "\t".join(["CHROM", "POS", "REF", "ALT", *samples]))
