"""Divergence audit of sources: how the word use of each source of a language differs from each other one.

Groups are pairs of language and source. Terms of a language are cut into slices of bounded size, so
that a group's vector is one compressed row per slice, and the rows of all groups of a slice have one
numbering of terms. The vectors meet by systolic rotation:

* resident: the rows are dealt over the cluster by (language, slice, seat) once, a group to a seat,
  and stay where they are;
* travelling: in each round of a round-robin tournament (the circle method) the seats of a language
  are paired, and one of each pair's vectors goes to the other's partition, compressed. Which of the two
  travels alternates, so that the work is even. A meeting evaluates both directions;
* a wave is as many rounds as let no seat receive more than `wave_bytes` at once. Each wave is one job
  whose results are written before the next, so what travels at a time is bounded, and a lost executor
  costs one wave. Only travelling rows are shuffled, residents keep their partitioning.

Before the first round the vector of the language itself visits each seat, and a local heap keeps the
`top` terms in which the group exceeds it; the heaps of a group's slices are merged by a ranking with a
limit per task. Sums of slices are exact integers.

A group meets the others by at most one row per slice and wave: a source with a third of all rows has
no larger rows than any, as a slice holds about `slice_terms` (term, source) pairs of all sources.
The result holds each pair of sources of a language, so sources are taken to be of a moderate number.

Value of a direction: the sum over the language's kept terms of floor((p - q)^2 / q), where
p = 1 + floor(SCALE * (count + 1) / (N + V)) in integers. Sums fit 64 bits while N < 9e15.

Edge cases: null text, language and source are ''; a group without any term has the smoothed share of
zero counts; a language with no kept term has pairs of value 0 and no terms; a language of one source
has no pair; repeated and null ids are rows as any other, for ids are not looked at; an empty table
gives an empty result; other columns are not looked at, whatever their names; ties go by the bytes of
the item; long texts are counted whole.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import materialise, text_of

#: What shares are multiplied by, three digits in base 1000.
SCALE = 1000**3
#: (term, source) pairs in a slice of a language, on average.
SLICE_TERMS = 200_000
#: Bytes of vectors that a seat may receive in one wave.
WAVE_BYTES = 64 << 20
#: Distinct terms a task counts before it hands them on.
HELD_TERMS = 400_000

#: Letters in lower case, bytes above ASCII as they are, all else a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_VECTOR = "lang string, slice int, source string, size int, terms binary, counts binary"
_PAIR = "lang string, source string, peer string, value long"
_TERM = "lang string, source string, slice int, place int, value long"


# ---------------------------------------------------------------- counts
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to counts and document counts of terms per group; the term '' tells that a group exists."""
    held, n = {}, 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            key = (lang, source)
            if key not in held:
                held[key] = (Counter({b"": 0}), Counter())
            counts, docs = held[key]
            n -= len(counts)
            words = text.as_py().translate(_FOLD).split()
            counts.update(words)
            docs.update(set(words))
            n += len(counts)
            if n >= HELD_TERMS:
                yield from _flush(held)
                held, n = {}, 0
    yield from _flush(held)


def _flush(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(terms), pa.string()),
            "source": pa.array([source] * len(terms), pa.string()),
            "term": pa.array(terms, pa.binary()).cast(pa.string()),
            "n": pa.array(list(counts.values()), pa.int64()),
            "docs": pa.array([docs[t] for t in terms], pa.int64()),
        })


def term_counts(docs: DataFrame, min_docs: int = 3, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, first): terms in `min_docs` documents of the language, and a row of term '' per group.

    `first` marks one row of each (lang, term).
    """
    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text")).mapInArrow(_count, _COUNTS)
    # Tasks have combined their rows; dealt by (lang, term), sums over a group and over its language need one shuffle.
    rows = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = W.Window.partitionBy("lang", "term")
    rows = rows.select("*", F.sum("docs").over(of_term).alias("all_docs"), (F.row_number().over(of_term.orderBy("source")) == 1).alias("first"))
    return rows.where((F.col("term") == "") | (F.col("all_docs") >= min_docs)).select("lang", "source", "term", "n", "first")


# ---------------------------------------------------------------- vectors
def _compress(numbers: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<i8").tobytes())


def _expand(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")


def _pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a slice: one vector per source, and the language's own with the terms themselves (source null)."""
    table = pa.Table.from_batches(batches)
    lang, piece = key[0].as_py(), key[1].as_py()
    names = pc.dictionary_encode(table.column("term")).combine_chunks()
    words = names.dictionary.cast(pa.binary()).to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    own = place[names.indices.to_numpy()]
    counts = table.column("n").to_numpy()
    total = np.zeros(len(words), np.int64)
    np.add.at(total, own, counts)
    sources = pc.dictionary_encode(table.column("source")).combine_chunks()
    at = sources.indices.to_numpy()
    by_source = np.lexsort((own, at))
    cuts = np.searchsorted(at[by_source], np.arange(len(sources.dictionary) + 1))
    rows = [(None, b"\n".join(words[i] for i in order), _compress(total))]
    for k, source in enumerate(sources.dictionary.to_pylist()):
        mine = by_source[cuts[k] : cuts[k + 1]]
        rows.append((source, _compress(np.diff(own[mine], prepend=0)), _compress(counts[mine])))
    yield pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * len(rows), pa.string()),
        "slice": pa.array([piece] * len(rows), pa.int32()),
        "source": pa.array([r[0] for r in rows], pa.string()),
        "size": pa.array([len(words)] * len(rows), pa.int32()),
        "terms": pa.array([r[1] for r in rows], pa.binary()),
        "counts": pa.array([r[2] for r in rows], pa.binary()),
    })


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact: a division digit by digit in base 1000, in Python's integers for the largest totals."""
    if total >= 9e15:
        return np.array([1 + SCALE * (c + 1) // total for c in counts.tolist()], np.int64)
    out, rest = np.divmod(counts.astype(np.int64) + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def _dense(row: dict) -> np.ndarray:
    """The shares of a vector's terms in a slice."""
    counts = np.zeros(row["size"], np.int64)
    if row["terms"] is not None:
        counts[np.cumsum(_expand(row["terms"]))] = _expand(row["counts"])
    return shares(counts, row["total"])


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _meet(key: tuple[pa.Scalar, ...], resident: pa.Table, arriving: pa.Table) -> pa.Table:
    """One seat in one wave: both directions of each meeting."""
    out = []
    for own in resident.to_pylist():
        p = _dense(own)
        for i in range(arriving.num_rows):
            peer = arriving.slice(i, 1).to_pylist()[0]
            q = _dense(peer)
            out.append((own["lang"], own["source"], peer["source"], int(_excess(p, q).sum())))
            out.append((own["lang"], peer["source"], own["source"], int(_excess(q, p).sum())))
    return _table(out, [("lang", pa.string()), ("source", pa.string()), ("peer", pa.string()), ("value", pa.int64())])


def _heap(top: int):
    def heap(key: tuple[pa.Scalar, ...], resident: pa.Table, arriving: pa.Table) -> pa.Table:
        """The visit of the language's own vector: the seat's `top` terms above it."""
        out = []
        for own in resident.to_pylist():
            for visitor in arriving.to_pylist():
                if own["terms"] is None:
                    continue
                places = np.cumsum(_expand(own["terms"]))
                p = shares(_expand(own["counts"]), own["total"])
                q = shares(_expand(visitor["counts"])[places], visitor["total"])
                above = np.flatnonzero(p > q)
                values = _excess(p[above], q[above])
                best = heapq.nsmallest(top, zip((-values).tolist(), places[above].tolist()))
                out += [(own["lang"], own["source"], own["slice"], place, -value) for value, place in best]
        return _table(out, [("lang", pa.string()), ("source", pa.string()), ("slice", pa.int32()), ("place", pa.int32()), ("value", pa.int64())])

    return heap


def _table(rows: list[tuple], fields: list) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(list(c), t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slice, the slice's terms, places) to a row per place."""
    for batch in batches:
        for row in batch.to_pylist():
            words, places = row["terms"].split(b"\n"), row["places"]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([row["lang"]] * len(places), pa.string()),
                "slice": pa.array([row["slice"]] * len(places), pa.int32()),
                "place": pa.array(places, pa.int32()),
                "term": pa.array([words[i] for i in places], pa.binary()).cast(pa.string()),
            })


# ---------------------------------------------------------------- rotation
def _arrivals(vectors: DataFrame, first: int, after: int) -> DataFrame:
    """Rows of the rounds from `first` to before `after`, with the seat they travel to as `host`."""
    seat, turn, even = F.col("seat"), F.col("turn"), F.col("even")
    others = even - 1
    # Seat k < others meets (turn - k) mod others; the one that would meet itself meets the last seat.
    own = F.pmod(turn - seat, others)
    meets = F.when(seat == others, F.col("fixed")).when(own == seat, others).otherwise(own)
    # 2k = turn modulo the odd number `others` has one solution.
    fixed = F.pmod(turn * ((others + 1) / 2).cast("int"), others)
    rounds = vectors.where(F.col("even") - 1 > first).withColumn("turn", F.explode(F.sequence(F.lit(first), F.least(F.lit(after), others) - 1)))
    rounds = rounds.withColumn("fixed", fixed).withColumn("host", meets.cast("int"))
    # Of two seats one travels, the lower one where their distance is even; the empty seat of an odd number meets no one.
    low = seat < F.col("host")
    goes = F.when((seat + F.col("host")) % 2 == 0, low).otherwise(~low)
    return rounds.where(goes & (F.col("host") < F.col("seats"))).drop("turn", "even", "fixed", "seats", "seat")


def audit(
    docs: DataFrame,
    min_docs: int = 3,
    top: int = 200,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    slice_terms: int = SLICE_TERMS,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has each other source of the language, part `term` the first `top` terms."""
    spark = docs.sparkSession
    counts = materialise(term_counts(docs, min_docs, lang_col, source_col, text_col))
    kept = counts.where("term <> ''")
    # A row per group, and one per language: small tables.
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_terms"), F.count_if(F.col("first") & (F.col("term") != "")).alias("firsts"), F.count_if(F.col("term") != "").alias("n_pairs"))
    groups = materialise(sums)
    seats = W.Window.partitionBy("lang")
    groups = materialise(
        groups.select(
            "lang", "source", "n_terms",
            F.sum("firsts").over(seats).alias("v"),
            F.sum("n_terms").over(seats).alias("lang_terms"),
            F.greatest(F.lit(1), F.ceil(F.sum("n_pairs").over(seats) / slice_terms)).cast("int").alias("slices"),
            (F.row_number().over(seats.orderBy("source")) - 1).alias("seat"),
            F.count(F.lit(1)).over(seats).cast("int").alias("seats"),
        ).withColumn("even", F.col("seats") + F.col("seats") % 2)
    )
    langs = materialise(groups.where("seat = 0").select("lang", "slices", "v", "lang_terms"))

    sliced = kept.join(langs.select("lang", "slices"), "lang").withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    packed = materialise(sliced.groupBy("lang", "slice").applyInArrow(_pack, _VECTOR))
    own = packed.where("source is null").join(langs.select("lang", (F.col("lang_terms") + F.col("v")).alias("total")), "lang")
    # Each group has a row in each slice, also where it has no term of it.
    frame = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    frame = frame.join(packed.where("source is null").select("lang", "slice", "size"), ["lang", "slice"])
    vectors = frame.join(packed.where("source is not null").drop("size"), ["lang", "slice", "source"], "left")
    vectors = materialise(vectors.select("lang", "slice", "source", "size", "terms", "counts", (F.col("n_terms") + F.col("v")).alias("total"), "seat", "seats", "even"))

    # The residents stay for all rounds; only what travels is shuffled from here on.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["lang", "slice", "source", "size", "terms", "counts", "total"]
    resident = vectors.select(*columns, "seat", "even").repartition(partitions, "lang", "slice", "seat").persist()
    try:
        # This action stores the residents; plans made after it know how they are dealt, and shuffle only the other side.
        size, rounds = resident.agg(F.max(F.length("terms") + F.length("counts")), F.max(F.col("even") - 1)).first()
        at_home = resident.groupBy("lang", "slice", "seat")
        visits = own.join(groups.select("lang", "seat"), "lang").select(*columns, F.col("seat").alias("host"))
        heaps = [materialise(at_home.cogroup(visits.groupBy("lang", "slice", "host")).applyInArrow(_heap(top), _TERM))]
        step = max(1, wave_bytes // max(1, size or 1))
        meetings = []
        for first in range(0, rounds or 0, step):
            arriving = _arrivals(vectors, first, first + step)
            wave = at_home.cogroup(arriving.groupBy("lang", "slice", "host")).applyInArrow(_meet, _PAIR)
            meetings.append(materialise(wave.groupBy("lang", "source", "peer").agg(F.sum("value").alias("value"))))
    finally:
        resident.unpersist()

    # A pair meets in one wave; a language without kept terms has no slice that meets.
    none = groups.where("v = 0").select("lang", "source")
    none = none.join(none.select("lang", F.col("source").alias("peer")), "lang").where("source <> peer").withColumn("value", F.lit(0).cast("long"))
    pairs = none
    for part in meetings:
        pairs = pairs.unionByName(part)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("peer").alias("item"), "value")

    places = heaps[0].groupBy("lang", "slice").agg(F.collect_set("place").alias("places"))
    words = packed.where("source is null").select("lang", "slice", "terms").join(places, ["lang", "slice"]).mapInArrow(_words, "lang string, slice int, place int, term string")
    found = heaps[0].join(words, ["lang", "slice", "place"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    by_value = W.Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = found.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(ranked)
