"""Token ids in a binary format of shuffled planes.

Documents are ranged by id over the cluster; each task encodes its documents in order and packs
them into shards. A shard is one self-contained byte string: fixed-size blocks of ids, each
transposed into byte planes (or bit planes), each plane a zstandard frame of its own, then an
index of all chunks and of the documents, then a footer. Shards end between documents, once they
hold `shard_ids` ids, so any number of tasks can read them and a lost task rewrites only its own.
Shards are written as the payload column of a Parquet folder, so that they reach any store that
Spark writes to and are committed as a whole; `export_shards` turns them into plain files.

Encoding goes through the tokenizers library. White space never reaches a token of a tokenizer
that drops it, so each distinct word (split at ASCII white space) is encoded once per worker and
remembered, up to CACHE_WORDS of them, after which the memory starts anew.

Edge cases: a null text is empty and holds only the end id; a null id comes last; equal ids are
ordered by a hash of the text and then as equals; an empty table gives no shard and an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import shared_dir, text_of

MAGIC = b"IDPL"
#: Ids in a block; planes of a block are at most this many bytes.
BLOCK_IDS = 1 << 16
#: A shard closes at the first document end after this many ids.
SHARD_IDS = 1 << 20
CACHE_WORDS = 1_000_000
_HEAD = struct.Struct("<4sBBHIQQ")  # magic, version, planes per id, 0, block ids, ids, documents
_FOOT = struct.Struct("<QQ4s")  # where the chunk index starts, where the document index starts, magic
SHARDS = "part int, shard int, first long, n_ids long, payload binary"


# ---------------------------------------------------------------- encoding
class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, for a lower-casing tokenizer with word ends that drops white space.

    Its split makes one piece of a run of letters and one of a run of other signs, and lower case
    does not depend on neighbours within ASCII and Latin-1. So a word of such letters with signs
    after it is the letters' ids and the signs' ids; any other word is encoded on its own.
    """

    #: Letters that have one lower case of one letter.
    latin = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    signs_after = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For letters in lower case, neither the normaliser nor the split has anything to do.
        self.lower = Tokenizer.from_file(path)
        self.lower.normalizer = None
        self.lower.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[bytes, bytes] = {}
        self.letters: dict[bytes, bytes] = {}
        self.signs: dict[bytes, bytes] = {b"": b""}
        #: Ids that end a piece.
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _whole(self, text: bytes) -> bytes:
        return np.asarray(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        words = text.split()  # of bytes: at ASCII white space alone, which is inside no special token
        found = list(map(self.words.get, words))
        if None in found:
            new = {w for w, f in zip(words, found) if f is None}
            if len(self.words) + len(new) > CACHE_WORDS:
                self.words.clear(), self.letters.clear()
                new, found = set(words), [None] * len(words)
            self._learn(new)
            known = self.words
            found = [known[w] if f is None else f for w, f in zip(words, found)]
        return b"".join(found)

    def _learn(self, words: set[bytes]) -> None:
        split = []
        for w in words:
            stem = w.rstrip(self.signs_after)
            if stem.isalpha():  # ASCII letters
                split.append((w, stem.lower(), w[len(stem) :]))
            elif stem and self.latin.fullmatch(text := stem.decode()):
                split.append((w, text.lower().encode(), w[len(stem) :]))
            else:
                self.words[w] = self._whole(w)
        letters, signs = self.letters, self.signs
        new = list({a for _, a, _ in split}.difference(letters))
        for i in range(0, len(new), 2000):
            some = new[i : i + 2000]
            ids = np.asarray(self.lower.encode(b" ".join(some).decode(), add_special_tokens=False).ids, "<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            data = ids.tobytes()
            pieces = [data[a:b] for a, b in zip([0, *cuts], cuts)] if len(cuts) == len(some) else map(self._whole, some)
            letters.update(zip(some, pieces))
        for w, stem, after in split:
            if after not in signs:
                signs[after] = self._whole(after)
            self.words[w] = letters[stem] + signs[after]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- format
def _planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if not bits:
        return [raw[:, k].tobytes() for k in range(4)]
    return [np.packbits((raw[:, k // 8] >> (k % 8)) & 1, bitorder="little").tobytes() for k in range(32)]


def _from_planes(planes: list[bytes], n: int) -> np.ndarray:
    raw = np.zeros((n, 4), np.uint8)
    if len(planes) == 4:
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, np.uint8)
    else:
        for k, p in enumerate(planes):
            raw[:, k // 8] |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") << (k % 8)
    return raw.reshape(-1).view("<u4")


def pack_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 1) -> bytes:
    """The bytes of one shard."""
    import zstandard

    z = zstandard.ZstdCompressor(level=level)
    out = [_HEAD.pack(MAGIC, 1, 32 if bits else 4, 0, block_ids, len(ids), len(doc_ids))]
    at, index = len(out[0]), []
    for i in range(0, len(ids), block_ids):
        for plane in _planes(ids[i : i + block_ids], bits):
            chunk = z.compress(plane)
            index += [at, len(chunk)]
            out.append(chunk)
            at += len(chunk)
    chunks_at = at
    out.append(np.asarray(index, "<u8").tobytes())
    docs_at = chunks_at + len(out[-1])
    known = np.asarray([x is not None for x in doc_ids], np.uint8)
    names = np.asarray([x or 0 for x in doc_ids], "<i8")
    out.append(z.compress(known.tobytes() + names.tobytes() + np.asarray(lengths, "<u8").tobytes()))
    out.append(_FOOT.pack(chunks_at, docs_at, MAGIC))
    return b"".join(out)


def read_block(shard: bytes, k: int) -> np.ndarray:
    """The ids of block `k` alone, through the chunk index."""
    import zstandard

    magic, _, planes, _, block_ids, n, _ = _HEAD.unpack_from(shard)
    chunks_at, docs_at, end = _FOOT.unpack_from(shard, len(shard) - _FOOT.size)
    if magic != MAGIC or end != MAGIC:
        raise ValueError("not a shard of token planes")
    index = np.frombuffer(shard, "<u8", (docs_at - chunks_at) // 8, chunks_at).reshape(-1, 2)
    z = zstandard.ZstdDecompressor()
    size = min(block_ids, n - k * block_ids)
    return _from_planes([z.decompress(shard[a : a + m]) for a, m in index[k * planes : (k + 1) * planes].tolist()], size)


def unpack_shard(shard: bytes) -> tuple[np.ndarray, list[int | None], list[int]]:
    """The ids, document ids and lengths of a shard."""
    import zstandard

    _, _, _, _, block_ids, n, docs = _HEAD.unpack_from(shard)
    _, docs_at, _ = _FOOT.unpack_from(shard, len(shard) - _FOOT.size)
    blocks = [read_block(shard, k) for k in range(-(-n // block_ids))]
    raw = zstandard.ZstdDecompressor().decompress(shard[docs_at : len(shard) - _FOOT.size]) if docs else b""
    known = np.frombuffer(raw, np.uint8, docs)
    names = np.frombuffer(raw, "<i8", docs, docs).tolist() if docs else []
    lengths = np.frombuffer(raw, "<u8", docs, 9 * docs).tolist() if docs else []
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4"), [x if k else None for x, k in zip(names, known.tolist())], lengths


# ---------------------------------------------------------------- write and read
def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    bits: bool = False,
    shard_ids: int = SHARD_IDS,
    block_ids: int = BLOCK_IDS,
    partitions: int | None = None,
) -> None:
    """Encode every text and write the shards to the folder `path`, in ascending id order."""
    spark = docs.sparkSession
    end = np.asarray([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)
        ids, names, lengths, held, shard, first = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            payload = pack_shard(np.frombuffer(b"".join(ids), "<u4"), names, lengths, block_ids, bits)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "first": pa.array([first], pa.int64()), "n_ids": pa.array([held], pa.int64()), "payload": pa.array([payload], pa.binary())})

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = encoder.encode(text.as_py()) + end
                ids.append(data)
                names.append(name)
                lengths.append(len(data) // 4)
                held += lengths[-1]
                if held >= shard_ids:
                    yield close()
                    ids, names, lengths, first, held, shard = [], [], [], first + held, 0, shard + 1
        if names:
            yield close()

    order = [F.col("id").asc_nulls_last(), F.col("tie").asc()]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    rows.select("id", "text").mapInArrow(shards, SHARDS).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """From the shards of `path`, per document: the id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    shards = spark.read.schema(SHARDS).parquet(path)
    # One row per task that wrote: sums over the tasks before it.
    before = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    bases = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = bases.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("first")).alias("base"), "payload")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, names, lengths = unpack_shard(payload.as_py())
                data = memoryview(ids.tobytes())
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - np.asarray(lengths, np.int64)
                out = {
                    id_col: pa.array(names, pa.int64()),
                    "start": pa.array(starts + base, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts.tolist(), ends.tolist())], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(documents, schema)


def export_shards(spark: SparkSession, path: str, folder: str) -> int:
    """Copies the shards one by one to plain files in a folder of the driver; how many there were."""
    n = 0
    for row in spark.read.schema(SHARDS).parquet(path).orderBy("part", "shard").toLocalIterator():
        with open(f"{folder}/{row['part']:06d}-{row['shard']:06d}.idp", "wb") as f:
            f.write(row["payload"])
        n += 1
    return n


def token_folder(spark: SparkSession, name: str) -> str:
    """A folder for shards in the shared folder."""
    return f"{shared_dir(spark)}/tokens/{name}"
