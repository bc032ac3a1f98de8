"""Toxic passages by maximum-scoring segments, and documents by extreme-value statistics.

Units are words and word beginnings (PREFIXES). From labelled documents each unit gets its
log-odds of standing in a toxic rather than a clean document, with a Dirichlet prior in
proportion to the unit's overall frequency (`prior` of all training documents as pseudo-counts),
and a z-score. Units with z >= `least_z` and log-odds >= `least_odds` score their log-odds, any
other word scores `-drift`; a word takes its most certain unit.

One linear pass over the scored words finds all maximal-scoring segments (Ruzzo and Tompa 1999).
Their significance follows the extreme-value law of segment scores of random sequences (Karlin
and Altschul 1990): a clean text of n words holds K n exp(-lambda S) segments of score S or more
by chance; lambda solves sum p(s) exp(lambda s) = 1 for the score distribution of the clean
training documents, K is the maximum-likelihood location given their best segments. Where the mean score of clean
text is not negative, so that there is no such lambda, the drift is raised until it is, and the
segments are searched anew. The evidence
of a document, the sum over its segments of lambda S - ln(K n) where positive, becomes a
probability by isotonic regression over bins of evidence.

All statistics are aggregates over all training documents; what reaches the driver is the model
(units that stand in `least_docs` toxic training documents and pass both thresholds, of the
labelled ids that `max_labels` bounds), one row per distinct score (in tenths) and one per bin of
evidence. Neither labels nor lang, source or id enter a score.

Edge cases: null and empty texts have no segment and score as any document without evidence;
without labels of both kinds every score is the base rate (0.5 without any label); rows are scored
one by one, so ties and repeated rows agree; an empty table gives an empty result; a text of any
length takes linear time; further columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of, training_rows

PREFIXES = (4, 5)
WORDS = re.compile(r"\w+")
BINS = 400
CACHE = 1_000_000


def units(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def unit_counts(train: DataFrame, text_col: str) -> DataFrame:
    """(unit, toxic, clean): documents of each kind that hold the unit; unit "" counts all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()

        def out() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            return pa.RecordBatch.from_pydict({"unit": pa.array(keys, pa.string()), "toxic": pa.array([seen[1][k] for k in keys], pa.int64()), "clean": pa.array([seen[0][k] for k in keys], pa.int64())})

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = set(WORDS.findall(text.as_py().lower()))
                found = {""} | words
                for k in PREFIXES:
                    found.update([w[:k] + "*" for w in words if len(w) > k])
                seen[label].update(found)
            if len(seen[0]) + len(seen[1]) > 500_000:
                yield out()
                seen[0].clear(), seen[1].clear()
        yield out()

    rows = train.select(text_of(text_col).alias("text"), "label").mapInArrow(run, "unit string, toxic long, clean long")
    return rows.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass
class Model:
    units: dict[str, tuple[float, float]] = field(default_factory=dict)
    drift: float = 0.1

    def score(self, word: str) -> float:
        """The word's own score, 0.0 if it has none."""
        known = [self.units[u] for u in units(word) if u in self.units]
        return max(known, key=lambda x: x[1])[0] if known else 0.0


def fit(train: DataFrame, text_col: str, prior: float, least_z: float, least_odds: float, least_docs: int, drift: float) -> Model:
    counts = materialise(unit_counts(train, text_col))
    total = counts.where("unit = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return Model(drift=drift)
    n1, n0 = total["toxic"], total["clean"]
    mass = max(10.0, prior * (n1 + n0))
    a = (F.col("toxic") + F.col("clean")) * F.lit(mass / (n1 + n0))
    odds = lambda y, n: F.log((y + a) / F.greatest(n + mass - y - a, F.lit(1e-9)))
    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    z = delta / F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))
    good = counts.where((F.col("unit") != "") & (F.col("toxic") >= least_docs)).select("unit", delta.alias("delta"), z.alias("z"))
    good = good.where((F.col("z") >= least_z) & (F.col("delta") >= least_odds))
    return Model({r["unit"]: (r["delta"], r["z"]) for r in good.toLocalIterator()}, drift)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first hit, last hit, score) of a sequence that scores -drift between the hits.

    hits: (place, positive score) in order. Linear in the hits: each candidate remembers the
    nearest one before it with a smaller left sum.
    """
    left, right, first, last, back = [], [], [], [], []
    total, before = 0.0, -1
    for k, (place, score) in enumerate(hits):
        total -= drift * (place - before - 1)
        before = place
        lo, hi, a = total, total + score, k
        total = hi
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = back[j]
            if j < 0 or right[j] >= hi:
                left.append(lo), right.append(hi), first.append(a), last.append(k), back.append(j)
                break
            lo, a = left[j], first[j]
            del left[j:], right[j:], first[j:], last[j:], back[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in zip(first, last, left, right)]


SEGMENT = "struct<start:long,end:long,n_words:long,score:double>"


def segments(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n_words, hits (scores in tenths), segments (start and end in code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        memory: dict[str, float] = {}
        for batch in batches:
            n_words, hits_of, found_of = [], [], []
            for text in batch.column(1):
                text = text.as_py().lower()
                words = WORDS.findall(text)
                n_words.append(len(words))
                hits, found = [], []
                if own.units:
                    scores = list(map(memory.get, words))
                    if None in scores:
                        if len(memory) > CACHE:
                            memory.clear()
                        for w in set(words):
                            if w not in memory:
                                memory[w] = own.score(w)
                        scores = list(map(memory.get, words))
                    if any(scores):
                        hits = [(i, s) for i, s in enumerate(scores) if s]
                if hits:
                    spans = [m.span() for m in WORDS.finditer(text)]
                    found = [{"start": spans[hits[a][0]][0], "end": spans[hits[b][0]][1], "n_words": hits[b][0] - hits[a][0] + 1, "score": s} for a, b, s in maximal_segments(hits, own.drift)]
                hits_of.append([round(10 * s) for _, s in hits])
                found_of.append(found)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(hits_of, pa.list_(pa.int32())), pa.array(found_of, kind)], names=["id", "n_words", "hits", "segments"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return materialise(rows.mapInArrow(run, f"id long, n_words long, hits array<int>, segments array<{SEGMENT}>"))


def negative_drift(scores: dict[float, float], drift: float) -> float:
    """`drift`, or twice the least drift for which the mean score of clean text is negative; scores: p of each positive score."""
    rest, mean = 1 - sum(scores.values()), sum(p * s for s, p in scores.items())
    return drift if mean < rest * drift else 2 * mean / max(rest, 1e-6)


def karlin_lambda(scores: dict[float, float], drift: float) -> float:
    """The positive solution of sum p(s) exp(lambda s) = 1; scores: p of each positive score. The mean has to be negative."""
    rest = 1 - sum(scores.values())
    f = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in scores.items()) + rest * math.exp(-x * drift) - 1
    low, high = 1e-6, 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return low


def isotonic(counts: list[tuple[int, int]], base: float) -> list[float]:
    """Non-decreasing probabilities by bin from (toxic, clean) counts; a pseudo-count of 2 at the base rate per block."""
    blocks: list[list[float]] = []
    for toxic, clean in counts:
        blocks.append([toxic, toxic + clean, 1])
        while len(blocks) > 1 and _rate(blocks[-2], base) >= _rate(blocks[-1], base):
            y, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y, blocks[-1][1] + n, blocks[-1][2] + k]
    return [_rate(b, base) for b in blocks for _ in range(int(b[2]))]


def _rate(block: list[float], base: float) -> float:
    return (block[0] + 2 * base) / (block[1] + 2)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float = 0.01,
    least_z: float = 3.0,
    least_odds: float = 1.5,
    least_docs: int = 5,
    max_labels: int = 200_000,
    drift: float = 0.1,
    level: float = 0.05,
) -> DataFrame:
    """Per row of `docs`: the id, n_words, evidence, score (0 to 1) and passages (the segments with E <= `level`).

    `keep` accepts the ids of `labels` to learn from.
    """
    train = training_rows(docs.select(id_col, text_col), labels, label_col, keep, max_labels, id_col)
    model = fit(train, text_col, prior, least_z, least_odds, least_docs, drift)
    while True:
        found = segments(docs, model, id_col, text_col)
        known = training_rows(found.withColumnRenamed("id", id_col), labels, label_col, keep, max_labels, id_col)
        clean = known.where("label = 0")
        words = clean.agg(F.sum("n_words")).first()[0] or 0
        scores = {r["s"] / 10: r["n"] / words for r in clean.select(F.explode("hits").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
        steeper = negative_drift(scores, model.drift)
        if steeper == model.drift:
            break
        model.drift = steeper
    lam = karlin_lambda(scores, model.drift) if scores else 1.0
    best = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    tail = clean.where("n_words > 0").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n_words") * F.exp(-lam * best)).alias("s")).first()
    k = tail["n"] / tail["s"] if tail["s"] else 1.0

    chance = F.log(F.greatest(F.col("n_words") * F.lit(k), F.lit(1.0)))
    gains = F.transform("segments", lambda s: F.greatest(s["score"] * lam - chance, F.lit(0.0)))
    evidence = F.aggregate(gains, F.lit(0.0), lambda a, x: a + x)
    place = F.least(F.ceil(F.col("evidence") * 4), F.lit(BINS)).cast("int")
    bins = {r["b"]: r for r in known.withColumn("evidence", evidence).groupBy(place.alias("b")).agg(F.sum("label").alias("y"), F.count(F.lit(1)).alias("n")).collect()}
    n, y = sum(r["n"] for r in bins.values()), sum(r["y"] for r in bins.values())
    rates = isotonic([(bins[b]["y"], bins[b]["n"] - bins[b]["y"]) if b in bins else (0, 0) for b in range(BINS + 1)], y / n if n else 0.5)
    # A little of the evidence itself orders documents within a bin.
    score = 0.999 * F.element_at(F.array(*[F.lit(r) for r in rates]), place + 1) + 0.001 * F.col("evidence") / (1 + F.col("evidence"))
    sure = F.filter("segments", lambda s: F.col("n_words") * F.lit(k) * F.exp(-lam * s["score"]) <= level)
    out = found.withColumn("evidence", evidence)
    return out.select(F.col("id").alias(id_col), "n_words", "evidence", score.alias("score"), sure.alias("passages"))
