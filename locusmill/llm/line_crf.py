"""Document quality from a linear-chain conditional random field over lines.

Each line of a text is good or bad. A line's features (length, shares of kinds of characters,
repetition of words, of the line and of the whole text) count together with those of the line
before and the line after it; transitions between neighbours have weights of their own. The field
is fitted by maximum conditional likelihood (L-BFGS over forward-backward marginals). Only
documents are labelled: lines start with their document's label, then the lines of bad documents
are given anew by the fitted field, at least one of them bad, and the field is fitted again.

A document's quality is the mean of its lines' marginal probabilities of being good, weighted by
length, and becomes a probability by isotonic regression over bins, with counts from all training
documents. The field itself is fitted on whole texts of a sample of labelled documents, about
`max_documents` of them and `max_bytes` bytes together (rows in the order of a hash; a row of more
than a twentieth of that is no part of the sample), a bound that does not grow with the input;
labelled ids are bounded by `max_labels`. Scoring reads whole texts, in blocks of documents, and
uses neither labels nor lang, source or id.

Edge cases: null and empty texts have one empty line; without labels of both kinds every score is
the base rate (0.5 without any label); rows are scored one by one, so ties and repeated rows
agree; an empty table gives an empty result; a text of very many lines takes linear time and, as
blocks are bounded by their cells (CELLS), no memory but its own; further columns are not looked
at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import materialise, text_of, training_rows
from .toxicity import isotonic

BINS = 200
#: Kinds of bytes; any byte of a longer UTF-8 sequence counts as a letter.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 1
_KIND[range(ord("A"), ord("Z") + 1)] = 2
_KIND[range(ord("0"), ord("9") + 1)] = 3
_KIND[[ord(c) for c in "#*$%&|<>"]] = 4
_KIND[[ord(c) for c in "!?"]] = 5
_KIND[[ord(c) for c in "\"'(),-./:;=@[\\]^_`{}~+"]] = 6
#: Texts that go through the recursions together hold no more cells (texts times lines of the longest), or are one text.
CELLS = 1 << 18


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, line lengths in bytes, where each text's lines start and end)."""
    lines_of = [t.split(b"\n") for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in lines_of])))
    n = int(starts[-1])
    length = np.fromiter((len(line) for x in lines_of for line in x), np.int64, n)
    # One more byte per line, so that no line is empty for reduceat.
    kinds = _KIND[np.frombuffer(b"".join(b"\n".join(x) + b"\n" for x in lines_of), np.uint8)]
    at = np.concatenate(([0], np.cumsum(length + 1)[:-1])) if n else np.zeros(0, np.int64)
    share = np.stack([np.add.reduceat(kinds == k, at, dtype=np.int64) for k in range(1, 7)], axis=1) if n else np.zeros((0, 6))
    words, distinct, again, of_text = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    last = np.zeros(n)
    k = 0
    for x in lines_of:
        seen: set[bytes] = set()
        every: set[bytes] = set()
        total, first = 0, k
        for line in x:
            own = line.split()
            words[k] = len(own)
            unlike = set(own)
            distinct[k] = len(unlike)
            every |= unlike
            total += len(own)
            if own:
                again[k] = line in seen
                seen.add(line)
                last[k] = own[-1][-1:] in b".!?"
            k += 1
        of_text[first:k] = 1 - len(every) / total if total else 0
    chars = np.maximum(share.sum(axis=1), 1)
    letters = np.maximum(share[:, 0] + share[:, 1], 1)
    w = np.maximum(words, 1)
    upper, digit, symbol, shout, point = share[:, 1] / letters, share[:, 2] / chars, share[:, 3] / chars, share[:, 4] / chars, share[:, 5] / chars
    like = 1 - distinct / w
    f = np.stack([
        np.log1p(length) / 5, np.log1p(words) / 5, np.minimum(chars / w, 40) / 10, upper, np.sqrt(digit), np.sqrt(symbol), np.sqrt(shout), np.sqrt(point), like, again,
        of_text, last, upper > 0.5, symbol > 0.05, shout > 0.05, (like > 0.5) & (words >= 5), of_text > 0.5, (words > 0) & (words < 4), length == 0, (words >= 5) & (point < 0.002),
    ], axis=1).astype(np.float64)
    return f, length, starts


def with_neighbours(f: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of the line, of the line before and of the line after (zero at the ends), and a constant."""
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    before[starts[:-1]] = 0
    after[starts[1:] - 1] = 0
    return np.concatenate([f, before, after, np.ones((len(f), 1))], axis=1)


def _padded(starts: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = (starts[1:] - starts[:-1])[order]
    steps = np.arange(sizes.max())
    mask = steps[None, :] < sizes[:, None]
    return np.where(mask, starts[:-1][order][:, None] + steps, 0), mask


def marginals(score: np.ndarray, trans: np.ndarray, starts: np.ndarray, pairs: bool = False, cells: int = CELLS):
    """Per line P(good); with `pairs` also the log partition of each text and the expected transitions.

    score: log-weight of good over bad per line; trans[a, b]: log-weight of state a before b.
    Texts of similar length go through the recursions together.
    """
    n = len(starts) - 1
    good, logz, expected = np.zeros(len(score)), np.zeros(n), np.zeros((2, 2))
    by_size = np.argsort(starts[1:] - starts[:-1], kind="stable")
    sizes = (starts[1:] - starts[:-1])[by_size]
    i = 0
    while i < n:
        # Sizes ascend: as many texts as the cells allow with the last one's length.
        most = int(np.searchsorted(np.arange(1, n - i + 1) * sizes[i:], cells, side="right"))
        order = by_size[i : i + max(1, most)]
        i += len(order)
        index, mask = _padded(starts, order)
        m, t = mask.shape
        emit = np.zeros((m, t, 2))
        emit[:, :, 1] = np.where(mask, score[index], 0)
        alpha, beta = np.zeros((m, t, 2)), np.zeros((m, t, 2))
        alpha[:, 0] = emit[:, 0]
        for s in range(1, t):
            step = np.logaddexp(alpha[:, s - 1, 0, None] + trans[0], alpha[:, s - 1, 1, None] + trans[1]) + emit[:, s]
            alpha[:, s] = np.where(mask[:, s, None], step, alpha[:, s - 1])
        for s in range(t - 2, -1, -1):
            ahead = emit[:, s + 1] + beta[:, s + 1]
            step = np.logaddexp(trans[:, 0] + ahead[:, 0, None], trans[:, 1] + ahead[:, 1, None])
            beta[:, s] = np.where(mask[:, s + 1, None], step, 0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        logz[order] = z
        # Past a text's end alpha only repeats; within it alpha + beta are the joint weights.
        p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])
        good[index[mask]] = np.clip(p[mask], 0, 1)
        if pairs and t > 1:
            joint = alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
            expected += np.exp(joint[mask[:, 1:]]).sum(axis=0)
    return (good, logz, expected) if pairs else good


@dataclass
class Field:
    weights: np.ndarray
    trans: np.ndarray

    def good(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f, length, starts = line_features(texts)
        return marginals(with_neighbours(f, starts) @ self.weights, self.trans, starts), length, starts


def fit_labels(x: np.ndarray, y: np.ndarray, starts: np.ndarray, ridge: float, rounds: int) -> Field:
    """Maximum conditional likelihood of the line labels y."""
    inner = np.ones(len(y), bool)
    inner[starts[:-1]] = False
    now = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[now - 1], y[now]), 1)
    n = len(starts) - 1

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        score = x @ w
        good, logz, expected = marginals(score, trans, starts, pairs=True)
        value = logz.sum() - (score * y).sum() - (seen * trans).sum()
        grad = np.concatenate([x.T @ (good - y), (expected - seen).ravel()])
        return value / n + ridge * theta @ theta / 2, grad / n + ridge * theta

    theta = _lbfgs(loss, np.zeros(x.shape[1] + 4), rounds)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def _lbfgs(loss, theta: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    value, grad = loss(theta)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, kept = grad.copy(), []
        for s, d in reversed(steps):
            a = (s @ q) / (s @ d)
            q -= a * d
            kept.append(a)
        if steps:
            s, d = steps[-1]
            q *= (s @ d) / (d @ d)
        for (s, d), a in zip(steps, reversed(kept)):
            q += s * (a - (d @ q) / (s @ d))
        size = 1.0 if steps else min(1.0, 1 / (np.linalg.norm(grad) + 1e-12))
        slope = grad @ q
        while size > 1e-8:
            following = theta - size * q
            v, g = loss(following)
            if v <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, d = following - theta, g - grad
        if s @ d > 1e-10:
            steps = [*steps[-memory + 1 :], (s, d)]
        done = value - v < 1e-6 * max(1.0, abs(value))
        theta, value, grad = following, v, g
        if done:
            break
    return theta


def fit(sample: list[tuple[bytes, int]], ridge: float = 1e-3, rounds: int = 60, passes: int = 2) -> Field | None:
    """The field of labelled texts; None without texts of both kinds."""
    labels = np.array([y for _, y in sample], np.int64)
    if not len(labels) or labels.min() == labels.max():
        return None
    f, _, starts = line_features([t for t, _ in sample])
    x = with_neighbours(f, starts)
    sizes = starts[1:] - starts[:-1]
    document = np.repeat(labels, sizes)
    y = document.copy()
    for k in range(passes):
        field = fit_labels(x, y, starts, ridge, rounds)
        if k < passes - 1:
            good = marginals(x @ field.weights, field.trans, starts)
            worst = np.minimum.reduceat(good, starts[:-1])
            y = np.where(document == 1, 1, (good > 0.5) & (good > np.repeat(worst, sizes))).astype(np.int64)
    return field


def line_marginals(docs: DataFrame, field: Field | None, id_col: str, text_col: str, with_lines: bool = False) -> DataFrame:
    """Per row: id, quality (length-weighted mean of P(good)), n_lines and, if asked for, lines (P(good) of each)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def blocks(texts: pa.Array, size: int = 4 << 20) -> Iterator[list[bytes]]:
        block, held = [], 0
        for text in texts:
            block.append(text.as_py())
            held += len(block[-1])
            if held >= size:
                yield block
                block, held = [], 0
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            quality, n_lines, lines = [], [], []
            for texts in blocks(batch.column(1).cast(pa.binary())):
                if own is None:
                    f, length, starts = None, None, np.concatenate(([0], np.cumsum([t.count(b"\n") + 1 for t in texts])))
                    good, length = np.full(starts[-1], 0.5), np.ones(starts[-1])
                else:
                    good, length, starts = own.good(texts)
                weight = length + 1.0
                sums = np.add.reduceat(np.stack([good * weight, weight]), starts[:-1], axis=1)
                quality += (sums[0] / sums[1]).tolist()
                n_lines += (starts[1:] - starts[:-1]).tolist()
                if with_lines:
                    lines += [good[a:b] for a, b in zip(starts[:-1], starts[1:])]
            out = {"id": batch.column(0), "quality": pa.array(quality, pa.float64()), "n_lines": pa.array(n_lines, pa.int64())}
            if with_lines:
                out["lines"] = pa.array(lines, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, quality double, n_lines long" + ", lines array<double>" * with_lines)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_documents: int = 2000,
    max_bytes: int = 64 << 20,
    max_labels: int = 200_000,
) -> DataFrame:
    """Per row of `docs`: the id, quality (the field's), n_lines, score (0 to 1, calibrated).

    `keep` accepts the ids of `labels` to learn from.
    """
    pairs = docs.select(id_col, text_col)
    sample = training_rows(pairs, labels, label_col, keep, max_documents, id_col).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), "label")
    # Whole rows of any size in the order of a hash, until their bytes are max_bytes, and the first row of each label.
    sample = materialise(sample.withColumns({"bytes": F.octet_length("text").cast("long"), "draw": F.xxhash64("id", F.xxhash64("text"))}).dropDuplicates(["draw", "id"]))
    order = W.Window.orderBy("draw", "id")  # about max_documents rows, without their texts
    drawn = sample.select("draw", "id", F.sum("bytes").over(order.rowsBetween(W.Window.unboundedPreceding, -1)).alias("before"), F.row_number().over(W.Window.partitionBy("label").orderBy("draw", "id")).alias("of_label"))
    drawn = drawn.where((F.coalesce("before", F.lit(0)) < max_bytes) | (F.col("of_label") == 1))
    sample = sample.join(F.broadcast(drawn.select("draw", "id")), ["draw", "id"])
    field = fit([(r["text"].encode("utf-8", "replace"), r["label"]) for r in sample.select("text", "label").toLocalIterator()])
    found = materialise(line_marginals(pairs, field, id_col, text_col))
    known = training_rows(found.withColumnRenamed("id", id_col), labels, label_col, keep, max_labels, id_col)
    place = F.floor(F.least(F.col("quality"), F.lit(0.999999)) * BINS).cast("int")
    bins = {r["b"]: r for r in known.groupBy(place.alias("b")).agg(F.sum("label").alias("y"), F.count(F.lit(1)).alias("n")).collect()}
    n, y = sum(r["n"] for r in bins.values()), sum(r["y"] for r in bins.values())
    rates = isotonic([(bins[b]["y"], bins[b]["n"] - bins[b]["y"]) if b in bins else (0, 0) for b in range(BINS)], y / n if n else 0.5)
    # A little of the quality itself orders documents within a bin.
    score = 0.99 * F.element_at(F.array(*[F.lit(r) for r in rates]), place + 1) + 0.01 * F.col("quality")
    return found.select(F.col("id").alias(id_col), "quality", "n_lines", score.alias("score"))
