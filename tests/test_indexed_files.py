"""Indexed binary inputs: score tracks and block-gzip text, read by ranges of bytes."""

import gzip
import os
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from locusmill.sources import bigwig, blockgzip, shards, sinks, tables
from locusmill.sources.ranged import RangedFile


# ---------------------------------------------------------------- score tracks
def track(path, rows, order="<", per=3, fan=4, hole=0):
    """A file of blocks of `per` rows (chromosome number, start, end, score); `hole` bytes of nothing before the last block."""
    names = [(f"chr{i}", 10**6) for i in range(1 + max(r[0] for r in rows))]
    blocks = []
    for c in range(len(names)):
        own = [r[1:] for r in rows if r[0] == c]
        for i in range(0, len(own), per):
            part = own[i : i + per]
            data = b"".join(struct.pack(order + "IIf", *r) for r in part)
            blocks.append((c, part[0][0], max(r[1] for r in part), zlib.compress(struct.pack(order + "IIIIIBBH", c, part[0][0], part[-1][1], 0, 0, 1, 0, len(part)) + data)))
    path.write_bytes(b"".join(bigwig.file_parts(blocks, names, order, fan)))
    return len(blocks)


def tracked(df):
    return sorted((r.chromosome, r.start, r.end, r.score) for r in df.collect())


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("fan", [2, 5, 256])
def test_track_round_trip_in_both_byte_orders(spark, tmp_path, order, fan):
    rng = random.Random(fan)
    rows = sorted((rng.randrange(3), s, s + rng.randint(1, 9), rng.randrange(100) / 4) for s in rng.sample(range(0, 10_000, 10), 200))
    track(tmp_path / "x.bw", rows, order, 3, fan)
    all_rows = sorted((f"chr{c}", s + 1, e, v) for c, s, e, v in rows)
    path = f"{tmp_path}/x.bw"
    assert tracked(bigwig.read_bigwig(spark, path, partition_bytes=200)) == all_rows
    regions = [("chr0", 500, 700), ("chr2", 9000, 9000), ("chr1", 1, 40), ("none", 1, 10**6)]
    found = tracked(bigwig.read_bigwig(spark, path, regions))
    touches = lambda r: any(r[0] == c and r[1] <= b and r[2] >= a for c, a, b in regions)
    assert set(filter(touches, all_rows)) <= set(found) <= set(all_rows) and len(found) < 60
    assert tracked(bigwig.read_bigwig(spark, path, [])) == []


def test_blocks_of_steps_and_without_compression():
    head = bigwig.Header("<", {7: "chrX"}, 0, False)
    variable = struct.pack("<IIIIIBBH", 7, 10, 90, 0, 5, 2, 0, 2) + struct.pack("<IfIf", 10, 1.0, 40, 2.0)
    fixed = struct.pack("<IIIIIBBH", 7, 100, 130, 10, 4, 3, 0, 3) + struct.pack("<fff", 1, 2, 3)
    assert [x.tolist() if hasattr(x, "tolist") else x for x in bigwig.intervals(variable, head)] == ["chrX", [10, 40], [15, 45], [1.0, 2.0]]
    assert [x.tolist() if hasattr(x, "tolist") else x for x in bigwig.intervals(fixed, head)] == ["chrX", [100, 110, 120], [104, 114, 124], [1.0, 2.0, 3.0]]


def test_bytes_read_follow_the_regions(tmp_path):
    rows = [(0, s, s + 5, 1.0) for s in range(0, 500_000, 10)]
    track(tmp_path / "x.bw", rows, per=50, fan=16)
    size = os.path.getsize(tmp_path / "x.bw")
    read = {}
    for label, regions in (("none", []), ("one", [("chr0", 1000, 1100)]), ("all", None)):
        reader = bigwig.BigWigReader({"path": f"{tmp_path}/x.bw"})
        reader.regions = regions
        parts = [p for p in reader.partitions() if p.blocks]
        with RangedFile(f"{tmp_path}/x.bw") as f:
            head = bigwig.read_header(f)
            list(bigwig.blocks_of(f, head, None if regions is None else bigwig.Regions(regions)))
            for p in parts:
                list(bigwig._together(f, p.blocks))
            read[label] = f.n_read
    assert read["none"] < size / 50 and read["one"] < size / 20 and read["all"] > size * 0.9


def test_a_file_above_two_gigabytes(spark, tmp_path):
    """A file with a hole before its last blocks, so that offsets pass 32 bits; only the blocks of the region are read."""
    path = tmp_path / "big.bw"
    block = zlib.compress(struct.pack("<IIIIIBBH", 0, 10, 20, 0, 0, 1, 0, 1) + struct.pack("<IIf", 10, 20, 0.5))
    far = 5 << 30
    chroms = struct.pack("<IIIIQQ", 0x78CA8C91, 1, 4, 8, 1, 0) + struct.pack("<BBH", 1, 0, 1) + b"chr1" + struct.pack("<II", 0, 100)
    index = struct.pack("<IIQIIIIQII", 0x2468ACE0, 1, 1, 0, 10, 0, 20, 0, 1, 0) + struct.pack("<BBH", 1, 0, 1) + struct.pack("<IIIIQQ", 0, 10, 0, 20, far, len(block))
    head = struct.pack("<IHHQQQHHQQIQ", 0x888FFC26, 4, 0, 64, far, far + len(block), 0, 0, 0, 0, 32768, 0)
    with open(path, "wb") as f:
        f.write(head + chroms)
        f.seek(far)
        f.write(block + index)
    assert tracked(bigwig.read_bigwig(spark, str(path), [("chr1", 15, 15)])) == [("chr1", 11, 20, 0.5)]


def test_written_tracks_read_back(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("chr"), F.col("id") % 7).alias("chromosome"), (F.col("id") * 3 + 1).alias("start"), (F.col("id") * 3 + 2).alias("end"), (F.col("id") % 64 / 8).alias("score"))
    written = bigwig.write_bigwig(rows, f"{tmp_path}/tracks", 100, ">").collect()
    assert sum(r.n for r in written) == 5000 and all(os.path.getsize(f"{tmp_path}/tracks/{r.file}") == r.bytes for r in written)
    assert tracked(bigwig.read_bigwig(spark, f"{tmp_path}/tracks")) == sorted(map(tuple, rows.collect()))
    near = bigwig.regions_of(spark.createDataFrame([("chr1", 10), ("chr1", 90), ("chr2", 301), (None, 5)], "chromosome string, position int"), width=100)
    assert near == [("chr1", 1, 100), ("chr2", 301, 400)]


def test_not_a_track(spark, tmp_path):
    (tmp_path / "x.bw").write_bytes(b"something else" * 10)
    with pytest.raises(Exception, match="not a BigWig"):
        bigwig.read_bigwig(spark, f"{tmp_path}/x.bw").collect()


# ---------------------------------------------------------------- block-gzip
def write_file(path, lines, header=b""):
    """Lines (chromosome, position, text) as one file with its index."""
    index = blockgzip.Index()
    path.write_bytes(b"".join(blockgzip.file_members(lines, header, index)))
    (path.parent / f"{path.name}.tbi").write_bytes(b"".join(index.parts()))
    return index


def random_lines(seed, n, width):
    rng = random.Random(seed)
    places = sorted((rng.choice(["1", "2", "X"]), rng.randrange(1, 3_000_000)) for _ in range(n))
    return [(c, p, f"{c}\t{p}\t{'acgt' * rng.randrange(width)}{i}".encode()) for i, (c, p) in enumerate(places)]


@pytest.mark.parametrize("n,width,header", [(0, 1, b"h"), (1, 3, b""), (3000, 40, b"h\t" * 10), (40, 40_000, b"h" * 200_000), (2000, 5, b"")])
def test_any_cut_of_a_file_gives_each_line_once(spark, tmp_path, n, width, header):
    lines = random_lines(n, n, width)
    write_file(tmp_path / "x.tsv.gz", lines, header)
    assert gzip.decompress((tmp_path / "x.tsv.gz").read_bytes()).splitlines() == ([header] if header else []) + [x[2] for x in lines]
    size = os.path.getsize(tmp_path / "x.tsv.gz")
    for part in {max(1, size // 7), max(1, size // 3), 10**9, 5_000}:
        reader = blockgzip.BlockGzipReader({"path": f"{tmp_path}/x.tsv.gz", "header": str(bool(header)).lower(), "partitionBytes": str(part)})
        got = [v for p in reader.partitions() for b in reader.read(p) for v in b.column(0).to_pylist()]
        assert got == [x[2].decode() for x in lines], part


@pytest.mark.parametrize("seed", range(3))
def test_regions_by_the_index_equal_a_scan(tmp_path, seed):
    rng = random.Random(seed)
    lines = random_lines(seed, 4000, 30)
    index = write_file(tmp_path / "x.tsv.gz", lines, b"a header")
    with RangedFile(f"{tmp_path}/x.tsv.gz.tbi") as f:
        assert (again := blockgzip.Index.read(f)).bins == index.bins and again.windows == index.windows
    for part in ("1000", "100000000"):
        for _ in range(15):
            regions = [(rng.choice(["1", "2", "X", "Y"]), a, a + rng.choice([0, 100, 50_000, 5_000_000])) for a in (rng.randrange(1, 3_300_000) for _ in range(rng.randint(0, 4)))]
            reader = blockgzip.BlockGzipReader({"path": f"{tmp_path}/x.tsv.gz", "partitionBytes": part})
            reader.regions = regions
            got = [v for p in reader.partitions() for b in reader.read(p) for v in b.column(0).to_pylist()]
            assert got == [t.decode() for c, p, t in lines if any(c == d and a <= p <= b for d, a, b in regions)]


def test_few_bytes_are_read_for_a_region(tmp_path, monkeypatch):
    rng = random.Random(2)
    lines = [(c, p, f"{c}\t{p}\t{rng.getrandbits(400):x}".encode()) for c, p, _ in random_lines(1, 30_000, 1)]
    write_file(tmp_path / "x.tsv.gz", lines)
    size, seen = os.path.getsize(tmp_path / "x.tsv.gz"), []
    monkeypatch.setattr(blockgzip, "READ_BYTES", 1 << 16)
    read = RangedFile.read
    monkeypatch.setattr(RangedFile, "read", lambda self, at, n: seen.append(len(out := read(self, at, n))) or out)
    reader = blockgzip.BlockGzipReader({"path": f"{tmp_path}/x.tsv.gz"})
    reader.regions = [("2", 1_000_000, 1_020_000)]
    got = [v for p in reader.partitions() for b in reader.read(p) for v in b.column(0).to_pylist()]
    assert got and sum(seen) < size / 8


def test_dosages_with_an_index(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("chr"), F.col("id") % 3).alias("chromosome"), (F.col("id") * 1000 + 1).cast("int").alias("position"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.array(F.col("id").cast("double") / 4, F.lit(None).cast("double")).alias("dosage"))
    written = blockgzip.write_dosages(rows, f"{tmp_path}/d", ["s1", "s2"]).collect()
    assert sum(r.n for r in written) == 3000
    key = lambda r: (r.variant_id, r.chromosome, r.position, r.dosage)
    want = sorted((f"chr{i % 3}_{i * 1000 + 1}_A_G", f"chr{i % 3}", i * 1000 + 1, [i / 4, None]) for i in range(3000))
    assert sorted(map(key, blockgzip.read_dosages(spark, f"{tmp_path}/d").collect())) == want
    found = blockgzip.read_dosages(spark, f"{tmp_path}/d", [("1", 100_000, 300_000), ("chr2", 5, 2001)])
    assert sorted(map(key, found.collect())) == [w for w in want if (w[1] == "chr1" and 100_000 <= w[2] <= 300_000) or (w[1] == "chr2" and w[2] <= 2001)]
    one = next(f"{tmp_path}/d/{r.file}" for r in written if r.n)
    assert blockgzip.header_of(one) == ["CHROM", "POS", "REF", "ALT", "s1", "s2"]
    # The plain reader of dosages takes such a file by its blocks, and an ordinary gzip file as text.
    assert tables.is_block_gzip(spark, one) and "blockgzip" in tables.dosages(spark, one)._jdf.queryExecution().toString().lower()
    (tmp_path / "plain.gz").write_bytes(gzip.compress(b"CHROM\tPOS\tREF\tALT\ts1\n1\t5\tA\tC\t2\n"))
    assert not tables.is_block_gzip(spark, f"{tmp_path}/plain.gz") and tables.dosages(spark, f"{tmp_path}/plain.gz").first().dosage == [2.0]


# ---------------------------------------------------------------- shards
def test_shards_of_equal_names_are_joined_by_whole_paths(spark, tmp_path):
    for i, folder in enumerate(("a", "b", "c d+é")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part-0.tsv").write_text(f"k\n{i}\n")
    paths = [f"{tmp_path}/{x}/part-0.tsv" for x in ("b", "a", "c d+é")]
    assert [r.k for r in shards.concatenate(spark, paths).collect()] == ["1", "0", "2"]
    # Folders of files, and a file that lies in none of them.
    sinks.write_text(spark.createDataFrame([("7",), ("8",)], "k string").coalesce(1), f"{tmp_path}/folder")
    assert [r.k for r in shards.concatenate(spark, [f"{tmp_path}/folder", paths[0]]).collect()] == ["7", "8", "1"]
    with pytest.raises(ValueError, match="twice"):
        shards.concatenate(spark, [paths[0], f"file:{paths[0]}"])


def test_skipped_shards_by_whole_paths(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "k int").coalesce(1)
    good.write.parquet(f"{tmp_path}/a/x.parquet")
    sinks.write_empty(spark, f"{tmp_path}/b/x.parquet", good.schema)
    paths = [f"{tmp_path}/{c}/x.parquet" for c in "ab"]
    assert shards.skipped_shards(spark, paths, good.schema) == paths[1:]
