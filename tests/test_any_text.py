"""Text files of any kind in one folder, and bulk copies."""

import gzip
import os
import random
import zlib

import pytest

from locusmill.sources import anytext, blockgzip, shards, tables
from locusmill.sources.ranged import RangedFile


def some_lines(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab\té") for _ in range(rng.choice([0, 3, 40]))) + str(i) for i in range(n)]


def parts_of(path, size):
    reader = anytext.AnyTextReader({"path": str(path), "partitionBytes": str(size)})
    return [v for p in reader.partitions() for b in reader.read(p) for v in b.column(0).to_pylist()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True, False])
def test_every_cut_of_every_kind_gives_each_line_once(tmp_path, end, last):
    lines = some_lines(1, 400)
    text = (end.join(lines) + (end if last else "")).encode()
    kinds = {
        "plain": text, "gzip": gzip.compress(text), "members": gzip.compress(text[:1000]) + gzip.compress(b"") + gzip.compress(text[1000:]), "padded": gzip.compress(text) + b"\0" * 700,
        "blocks": b"".join(blockgzip.pack_member(text[i : i + 300]) for i in range(0, len(text), 300)) + blockgzip.END,
    }
    for name, data in kinds.items():
        (tmp_path / name).write_bytes(data)
        for size in (1, 7, 100, 1000, 10**6) if name != "blocks" else (100, 1000, 10**6):
            assert parts_of(tmp_path / name, size) == lines, (name, size)


def test_empty_files_and_blank_lines(tmp_path):
    for name, data in (("a", b""), ("b", gzip.compress(b"")), ("c", b"\n\nx\n\n")):
        (tmp_path / name).write_bytes(data)
    assert parts_of(tmp_path, 2) == ["", "", "x", ""]


def test_a_cut_off_file_is_an_error(tmp_path):
    (tmp_path / "x").write_bytes(gzip.compress(os.urandom(5000))[:-2000])
    with pytest.raises(ValueError, match="within a member"):
        parts_of(tmp_path / "x", 10)


def test_a_large_file_is_inflated_in_bounded_memory(tmp_path):
    """64 MB of text in one member of a few kB: pieces are small."""
    z = zlib.compressobj(9, zlib.DEFLATED, 31)
    with open(tmp_path / "x", "wb") as f:
        for _ in range(64):
            f.write(z.compress(b"0123456789abcde\n" * 65536))
        f.write(z.flush())
    with RangedFile(f"{tmp_path}/x") as f:
        sizes = [len(p) for p in anytext.inflate(f)]
    assert sum(sizes) == 64 << 20 and max(sizes) <= anytext.READ_BYTES


def test_a_folder_of_mixed_files_is_one_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for i in range(6):
        text = f"k\tv\n{i}\tx\n{i + 10}\tNA\n".encode()
        (tmp_path / "t" / f"part-{i}").write_bytes([text, gzip.compress(text), blockgzip.pack_member(text) + blockgzip.END][i % 3])
    got = tables.read_delimited(spark, f"{tmp_path}/t", schema="k int, v string").collect()
    assert sorted((r.k, r.v) for r in got) == sorted([(i, "x") for i in range(6)] + [(i + 10, None) for i in range(6)])
    assert not tables.is_gzip(spark, f"{tmp_path}/none") and tables.is_gzip(spark, f"{tmp_path}/t")


# ---------------------------------------------------------------- copies
def test_a_manifest_of_a_thousand_files(spark, tmp_path):
    rng = random.Random(3)
    (tmp_path / "in").mkdir()
    paths, content = [], {}
    for i in range(1000):
        folder = tmp_path / "in" / str(i % 7)
        folder.mkdir(exist_ok=True)
        data = rng.randbytes(rng.choice([0, 10, 3000]))
        (folder / f"{i // 7}.bin").write_bytes(data)
        paths.append(f"{folder}/{i // 7}.bin")
        content[paths[-1]] = data
    gone = f"{tmp_path}/in/0/gone.bin"
    for _ in range(2):  # again into the same folder, with the same result
        rows = shards.copy_shards(spark, [*paths, gone], f"{tmp_path}/out", 8).collect()
        found = {r.source: r for r in rows}
        assert len(rows) == 1001 and found[gone].error and found[gone].bytes is None
        for p, data in content.items():
            r = found[p]
            assert (r.bytes, r.crc32, r.error) == (len(data), zlib.crc32(data), None) and open(r.target, "rb").read() == data
        assert len(os.listdir(tmp_path / "out")) == 1000


def test_a_copy_that_fails_is_tried_again(tmp_path, monkeypatch):
    from locusmill.sources import copying

    (tmp_path / "a").write_bytes(b"data" * 1000)
    write, calls = copying.write_bytes, []

    def flaky(path, parts):
        calls.append(path)
        if len(calls) < 3:
            raise OSError("connection reset")
        return write(path, parts)

    monkeypatch.setattr(copying, "write_bytes", flaky)
    assert copying.copy_file(f"{tmp_path}/a", f"{tmp_path}/b", 3, 0)[:3] == (4000, zlib.crc32(b"data" * 1000), 3)
    assert copying.copy_file(f"{tmp_path}/a", f"{tmp_path}/c", 1, 0)[2:] == (1, None)
    calls.clear()
    assert copying.copy_file(f"{tmp_path}/a", f"{tmp_path}/d", 2, 0)[2:] == (2, "connection reset") and not os.path.exists(tmp_path / "d")


def test_files_are_dealt_by_their_bytes(spark, tmp_path):
    """One file holds most bytes: it is a task's alone, and the small ones share the others."""
    from locusmill.sources import copying

    names = [f"{i:03d}" for i in range(60)]
    for n in names:
        (tmp_path / n).write_bytes(b"x" * (100_000 if n == "030" else 100))
    pairs = spark.createDataFrame([(f"{tmp_path}/{n}", f"{tmp_path}/to/{n}") for n in names], "source string, target string")
    parts = copying.copy_files(pairs, 4).rdd.glom().map(lambda rows: sum(r.bytes for r in rows)).collect()
    assert sum(parts) == 105_900 and sorted(parts)[-2] <= 6_000
