"""Token counts by batch encoding: Arrow functions that hand texts to the tokenizer in batches and return lengths only.

A byte-level tokenizer splits text before it looks for merges, and its split never joins a sign to
white space after it. So a text may be cut before any white space that follows another sign, and
the parts have the tokens of the whole (`SafeCuts`). Three things follow from this:

* texts are counted in batches of about `batch_bytes`, whatever their number: a batch is cut into
  parts, each distinct part is encoded once, and its length counts for all its places;
* a text above `long_bytes` does not stay with the task that read it: it leaves as chunks of about
  `chunk_bytes`, cut at the same boundaries, which are dealt evenly over the cluster, counted there
  and summed, so one text of gigabytes is nobody's tail;
* a part without white space that is itself long is cut where a letter meets a digit or a stop.

Lengths of parts are remembered per worker, up to CACHE_PARTS of them, then the memory starts anew.
A tokenizer whose split is of another kind (`SafeCuts.fit` tells by its settings) gets whole texts,
each in one call, and only batches stay.

Edge cases: a null text is empty and has no token; null and repeated ids are rows as any other; an
empty table gives an empty result; other columns are not looked at, whatever their names. Special
strings in a text are what the library makes of them by default, one token each.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of

#: Parts whose lengths a worker remembers, and the longest of them in characters.
CACHE_PARTS, CACHE_CHARS = 800_000, 100
BATCH_BYTES = 1 << 20
CHUNK_BYTES = 1 << 18
LONG_BYTES = 4 << 20
_FIRST = "uid long, id string, n_bytes long, n_tokens long, chunk string"


class SafeCuts:
    """Where a text may be cut so that its parts have its tokens.

    White space here is ASCII's; `other` are signs that some tables of Unicode take for white space,
    after which nothing is cut.
    """

    space = r"\x20\x09-\x0D"
    other = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
    parts = re.compile(rf"[{space}]*[^{space}]+(?:(?<=[{other}])[{space}]+[^{space}]*)*|[{space}]+")
    #: Inside a part: letters of old blocks of Unicode before digits and stops.
    inside = re.compile(r"(?<=[A-Za-z\u0410-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])(?=[0-9,.;:!?\u3001\u3002\uff01\uff0c\uff1f])")

    @classmethod
    def fit(cls, path: str) -> bool:
        """Whether the tokenizer's file has the split that the cuts need."""
        with open(path, encoding="utf-8") as f:
            top = json.load(f)
        split = top.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        added = [t for t in top.get("added_tokens") or [] if t["lstrip"] or t["rstrip"] or t.get("single_word") or re.search(r"\s", t["content"]) or cls.inside.search(t["content"])]
        model = top.get("model") or {}
        affixes = model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
        return plain and not added and not top.get("normalizer") and not affixes and model.get("type") == "BPE"

    @classmethod
    def chunks(cls, text: str, size: int) -> Iterator[str]:
        """Consecutive runs of parts of about `size` characters; a longer part is a run of its own, cut inside where it can be."""
        held, n = [], 0
        for m in cls.parts.finditer(text):
            part = m.group()
            if n and n + len(part) > size:
                yield "".join(held)
                held, n = [], 0
            if len(part) > size:
                yield from cls._cut(part, size)
            else:
                held.append(part)
                n += len(part)
        if held:
            yield "".join(held)

    @classmethod
    def _cut(cls, part: str, size: int) -> Iterator[str]:
        start = 0
        for m in cls.inside.finditer(part):
            if m.start() - start >= size:
                yield part[start : m.start()]
                start = m.start()
        yield part[start:]


class Counter:
    """Numbers of tokens of texts, by the library's batch encoding."""

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cuts = SafeCuts.fit(path)
        self.batch_bytes = batch_bytes
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        if not self.cuts:
            return self._encode(texts)
        parts = [SafeCuts.parts.findall(t) for t in texts]
        new = set().union(*parts).difference(self.known)
        if len(self.known) + len(new) > CACHE_PARTS:
            self.known.clear()
            new = set().union(*parts)
        long = sorted(p for p in new if len(p) > CACHE_CHARS)
        short = list(new.difference(long))
        known = self.known
        known.update(zip(short, self._encode(short)))
        if not long:
            return [sum(map(known.__getitem__, own)) for own in parts]
        own_long = {}
        for p in long:  # of one long part, its own cuts are a batch
            own_long[p] = sum(self._encode(list(SafeCuts._cut(p, CHUNK_BYTES))))
        return [sum(own_long[p] if p in own_long else known[p] for p in own) for own in parts]

    def _encode(self, texts: list[str]) -> list[int]:
        out, start, held = [], 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= self.batch_bytes or i + 1 == len(texts):
                out += map(len, self.tokenizer.encode_batch_fast(texts[start : i + 1], add_special_tokens=False))
                start, held = i + 1, 0
        return out


_counters: dict[tuple[str, int], Counter] = {}


def _counter(path: str, batch_bytes: int) -> Counter:
    key = (path, batch_bytes)
    if key not in _counters:
        _counters[key] = Counter(path, batch_bytes)
    return _counters[key]


def _batches(texts: Iterator[tuple[object, str]], size: int) -> Iterator[tuple[list, list[str]]]:
    """Rows in groups of about `size` characters."""
    keys, own, n = [], [], 0
    for key, text in texts:
        keys.append(key)
        own.append(text)
        n += len(text)
        if n >= size:
            yield keys, own
            keys, own, n = [], [], 0
    if own:
        yield keys, own


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    batch_bytes: int = BATCH_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """One row per row of `docs`: the id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    `tokenizer` is a file of the tokenizers library that every executor can open.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, batch_bytes)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            whole = np.flatnonzero((sizes <= long_bytes) | (not counter.cuts))
            texts = ((i, batch.column(1)[i].as_py()) for i in whole.tolist())
            for own, some in _batches(texts, batch_bytes):
                yield _rows(range(uid, uid + len(own)), batch.column(0).take(pa.array(own)), sizes[own], counter.count(some), [None] * len(own))
                uid += len(own)
            for i in np.setdiff1d(np.arange(len(sizes)), whole).tolist():
                name = batch.column(0).slice(i, 1)
                for chunk in SafeCuts.chunks(batch.column(1)[i].as_py(), chunk_bytes):
                    yield _rows([uid], name, sizes[i : i + 1], [None], [chunk])
                uid += 1

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, batch_bytes)
        for batch in batches:
            chunks = zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)))
            for own, some in _batches(chunks, batch_bytes):
                yield pa.RecordBatch.from_pydict({"uid": pa.array(own, pa.int64()), "n": pa.array(counter.count(some), pa.int64())})

    seen = materialise(rows.mapInArrow(first, _FIRST))
    done = seen.where("chunk is null").select("id", "n_bytes", "n_tokens")
    parts = seen.where("chunk is not null")
    # Chunks are of one size, so dealing them in turn deals the bytes evenly.
    sums = parts.select("uid", "chunk").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(rest, "uid long, n long")
    names = parts.groupBy("uid").agg(F.first("id").alias("id"), F.first("n_bytes").alias("n_bytes"))
    long = names.join(sums.groupBy("uid").agg(F.sum("n").alias("n_tokens")), "uid").select("id", "n_bytes", "n_tokens")
    out = done.unionByName(long)
    return out.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _rows(uids, names, sizes, tokens, chunks) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "uid": pa.array(uids, pa.int64()),
        "id": names,
        "n_bytes": pa.array(sizes, pa.int64()),
        "n_tokens": pa.array(tokens, pa.int64()),
        "chunk": pa.array(chunks, pa.string()),
    })
