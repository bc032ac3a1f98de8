"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source gets a share of the total budget by weight; no source may give more than `most`
times its own size, and what it cannot give is dealt to the others by weight until none is above
its limit (water filling). Each source's documents are put in a pseudo-random order, pass after
pass, and every copy gets a virtual finish time: the source's words so far, this copy included,
divided by the source's target. All copies together are ranged by finish time and the mix is the
longest front of that order whose words do not pass the budget.

The front need not be summed up from its start: a source's copies that finish by time 1 hold no
more than its target, and the targets are the budget, so all copies up to time 1 are in it. What
the budget still holds then goes to the copies that finish after 1, in their order, whatever their
source, up to the first that no longer fits. Positions in a source's queue are prefix sums in
three levels (row, bucket, bucket of buckets), and the end of the front is found by narrowing a
histogram of finish times, so neither a hot source nor the global order meets in one task.

Rows of the same id, text and source are one entry of the queue with a count, so that a key that
holds much of the input is no bucket of its own; an entry's copies are dealt to its rows evenly.
`mix` writes rows in the order of their finish times: as these are spread evenly over virtual
time, a partition is an interval of time and needs no sampling of the texts.

Edge cases: a null text has size 0; a null source is a source of its own, last in the order;
documents of size 0 are never taken; repeated and null ids are separate documents; an empty table
gives an empty result; equal finish times are ordered by source, order key and content. Reruns
agree: the order key is a hash of id, text and seed. Other columns keep their values, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..operators.chunks import numbered
from .common import content_key, materialise, n_words, same, text_of

#: Documents in a bucket of the largest source, on average.
PER_BUCKET = 1000
#: Slices of a histogram of finish times.
SLICES = 1000
#: So few copies at the end of the front are put in order by one task.
AT_ONCE = 10_000
#: Words in a partition of the mix, and the largest number of partitions.
PARTITION_WORDS, MOST_PARTITIONS = 4_000_000, 20_000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """From sizes(source, source_size): source, source_size, target.

    Sources by code point, null last, take the weights in turn. The level to which the water
    rises is found by rounds of one small aggregate: sources above their limit are set to it and
    the rest shares what is left, until none is above.
    """
    ordered = numbered(materialise(sizes.select("source", "source_size", F.col("source").isNull().alias("none"))), ["none", "source"], "turn")
    by_turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = materialise(ordered.select("source", "source_size", by_turn.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("limit")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("limit")
        free, fixed = rows.agg(F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, F.col("limit")))).first()
        following = (share * total - (fixed or 0.0)) / free if free else level
        if not free or following <= level:
            break
        level = following
    return rows.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"))


def _queue(rows: DataFrame) -> DataFrame:
    """Entries (source, key, h1, h2, size, n, start): rows of one id, text and source, and the words before them in their source's order."""
    entries = rows.where("size > 0").groupBy("source", "key", "h1", "h2").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    entries = materialise(entries.withColumn("words", F.col("size") * F.col("n")))
    largest = entries.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    bits = (largest // PER_BUCKET).bit_length()
    # The leading bits of the key, so that buckets are in its order.
    bucket = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits) if bits else F.lit(0).cast("long")
    entries = entries.withColumn("bucket", bucket)
    before = lambda by, order: W.Window.partitionBy(*by).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, -1)
    # Prefix sums over buckets of 1024 buckets, over buckets inside these, and over entries inside a bucket.
    held = materialise(entries.groupBy("source", F.shiftright("bucket", 10).alias("super"), "bucket").agg(F.sum("words").alias("held")))
    above = held.groupBy("source", "super").agg(F.sum("held").alias("held"))
    above = above.select(F.col("source").alias("s"), F.col("super").alias("u"), F.coalesce(F.sum("held").over(before(["source"], ["super"])), F.lit(0)).alias("far"))
    held = held.withColumn("near", F.coalesce(F.sum("held").over(before(["source", "super"], ["bucket"])), F.lit(0)))
    held = held.join(above, same(held, above, {"source": "s", "super": "u"})).select("s", F.col("bucket").alias("b"), (F.col("far") + F.col("near")).alias("base"))
    inside = F.coalesce(F.sum("words").over(before(["source", "bucket"], ["key", "h1", "h2"])), F.lit(0))
    entries = entries.withColumn("inside", inside)
    return entries.join(held, same(entries, held, {"source": "s", "bucket": "b"})).select("source", "key", "h1", "h2", "size", "n", (F.col("base") + F.col("inside")).alias("start"))


def _copies_by(time: float, most: int) -> Column:
    """How many copies of an entry finish by a virtual time, over all passes."""
    out = F.lit(0).cast("long")
    for again in range(most):
        k = F.floor((F.lit(time) * F.col("target") + F.lit(1e-9) * F.col("target") - F.lit(again) * F.col("source_size") - F.col("start")) / F.col("size"))
        out = out + F.least(F.greatest(k, F.lit(0)), F.col("n"))
    return out


def _front(entries: DataFrame, most: int, rest: float) -> DataFrame | None:
    """(source, key, h1, h2, more): copies that finish after time 1 and still fit `rest` words, in the order of their finish times; None if there is none."""
    number = F.col("source_size") * F.lit(int(most))
    late = entries.where((F.col("target") > 0) & (number > F.col("target") * (1 + 1e-9)))
    # Twice the words that are asked for lie within this time after 1, if sources have so many; it grows until they do.
    open_target = late.select("source", "target").distinct().agg(F.sum("target")).first()[0]
    if not open_target or rest <= 0:
        return None
    reach = max(2.0 * rest / open_target, 1e-9)
    while True:
        words = late.agg(F.sum((_copies_by(1.0 + reach, most) - F.col("taken")) * F.col("size"))).first()[0] or 0
        if words > rest or reach > most * 1e9:
            break
        reach *= 4
    done = F.col("taken")
    late = late.withColumn("to", _copies_by(1.0 + reach, most)).where(F.col("to") > done)
    place = F.sequence(done + 1, F.col("to"))
    copies = late.withColumn("c", F.explode(place))
    again, j = F.floor((F.col("c") - 1) / F.col("n")), F.pmod(F.col("c") - 1, F.col("n")) + 1
    finish = (again * F.col("source_size") + F.col("start") + j * F.col("size")) / F.col("target")
    copies = materialise(copies.select("source", "key", "h1", "h2", "c", "size", finish.alias("finish")))
    # The slice of time in which the budget ends, and in it again, until one task can put it in order.
    low, width, base = copies.agg(F.min("finish")).first()[0], None, 0
    high = copies.agg(F.max("finish")).first()[0]
    inside = copies
    front = None
    while inside.count() > AT_ONCE and high > low:
        width = (high - low) / SLICES
        at = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(SLICES - 1))
        sums = {r["s"]: r["w"] for r in inside.groupBy(at.alias("s")).agg(F.sum("size").alias("w")).collect()}  # at most SLICES rows
        ends = next((s for s in sorted(sums) if base + sum(w for t, w in sums.items() if t <= s) > rest), None)
        if ends is None:
            break
        taken = inside.where(at < ends)
        front = taken if front is None else front.unionByName(taken)
        base += sum(w for t, w in sums.items() if t < ends)
        inside = inside.where(at == ends)
        low, high = inside.agg(F.min("finish"), F.max("finish")).first()
    order = W.Window.orderBy("finish", F.col("source").asc_nulls_last(), "key", "h1", "h2", "c").rowsBetween(W.Window.unboundedPreceding, 0)
    last = inside.withColumn("upto", F.sum("size").over(order)).where(F.col("upto") + F.lit(base) <= F.lit(rest + 1e-6)).drop("upto")
    front = last if front is None else front.unionByName(last)
    return front.groupBy("source", "key", "h1", "h2").agg(F.count(F.lit(1)).alias("more"))


def _plan(rows: DataFrame, weights: Sequence[float], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """(sources, entries) from rows(source, key, h1, h2, size): source, source_size, target; and the queue's entries with their place and copies taken."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, most))
    t = targets.select(F.col("source").alias("s"), "source_size", "target")
    entries = _queue(rows)
    entries = entries.join(t, same(entries, t, {"source": "s"})).drop("s")
    entries = materialise(entries.withColumn("taken", F.when(F.col("target") > 0, _copies_by(1.0, most)).otherwise(0)))
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    spent = entries.agg(F.sum(F.col("taken") * F.col("size"))).first()[0] or 0
    front = _front(entries, most, budget - spent)
    if front is not None:
        more = front.withColumnsRenamed({"source": "s", "key": "k", "h1": "a", "h2": "b"})
        entries = entries.join(more, same(entries, more, {"source": "s", "key": "k", "h1": "a", "h2": "b"}), "left").drop("s", "k", "a", "b")
        entries = materialise(entries.withColumn("taken", F.col("taken") + F.coalesce("more", F.lit(0))).drop("more"))
    return targets, entries


def _dealt(rows: DataFrame, entries: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of rows(source, key, h1, h2, ...) with size, start, source_size, target and copies of the entry; its copies are dealt evenly to its rows."""
    e = entries.select(F.col("source").alias("s"), F.col("key").alias("k"), F.col("h1").alias("a"), F.col("h2").alias("b"), F.col("size").alias("e_size"), "start", "n", "taken", F.col("source_size").alias("e_source"), F.col("target").alias("e_target"))
    out = rows.join(e, same(rows, e, {"source": "s", "key": "k", "h1": "a", "h2": "b"}), "left").drop("s", "k", "a", "b")
    out = out.withColumn("copies", F.coalesce(F.floor(F.col("taken") / F.col("n")), F.lit(0)).cast("long")).withColumn("odd", F.coalesce(F.pmod("taken", "n"), F.lit(0)))
    shown = [*columns, "source", "key", "h1", "h2", "e_size", "start", "e_source", "e_target", "copies"]
    if entries.where("n > 1 and taken % n <> 0").isEmpty():
        return out.select(*shown)
    # Some entry's copies do not go evenly into its rows: its first rows, numbered in two levels, get one more.
    some = materialise(out.where("odd > 0").withColumn("part", F.spark_partition_id()).withColumn("uid", F.monotonically_increasing_id()))
    key = ["source", "key", "h1", "h2"]
    parts = some.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("m"))
    base = F.coalesce(F.sum("m").over(W.Window.partitionBy(*key).orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("source").alias("s"), F.col("key").alias("k"), F.col("h1").alias("a"), F.col("h2").alias("b"), F.col("part").alias("p"), base.alias("base"))
    own = F.row_number().over(W.Window.partitionBy(*key, "part").orderBy("uid"))
    some = some.withColumn("own", own)
    some = some.join(parts, same(some, parts, {"source": "s", "key": "k", "h1": "a", "h2": "b", "part": "p"}))
    some = some.withColumn("copies", F.col("copies") + (F.col("base") + F.col("own") <= F.col("odd")).cast("long"))
    return out.where("odd = 0").select(*shown).unionByName(some.select(*shown))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, **columns: Column) -> DataFrame:
    """(source, key, h1, h2, size) of every row, and further columns."""
    text = text_of(text_col)
    h1, h2 = content_key(text)
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), h1.alias("h1"), h2.alias("h2"), n_words(text).alias("size"), *[c.alias(k) for k, c in columns.items()])
    return rows.withColumn("key", F.xxhash64(F.col("id"), F.col("h1"), F.lit(seed)))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
) -> DataFrame:
    """One row per row of `docs`: the id, size, source_size, target, copies, taken (words, repeats counted)."""
    rows = materialise(_keyed(docs, id_col, text_col, source_col, seed))
    targets, entries = _plan(rows, weights, share, most)
    out = _dealt(rows, entries, ["id", "size"])
    t = targets.select(F.col("source").alias("s"), "source_size", "target")
    out = out.join(t, same(out, t, {"source": "s"}))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
) -> DataFrame:
    """The mixed corpus in the order of the finish times: rows of `docs` with all their columns, each as often as the plan takes it."""
    narrow = materialise(_keyed(docs, id_col, text_col, source_col, seed))
    _, entries = _plan(narrow, weights, share, most)
    words = entries.agg(F.sum(F.col("taken") * F.col("size"))).first()[0] or 0
    rows = _keyed(docs, id_col, text_col, source_col, seed, row=F.struct("*"))
    entries = entries.where("taken > 0")
    out = _dealt(rows, entries, ["row"]).where("copies > 0")
    out = out.withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    finish = (F.col("again") * F.col("e_source") + F.col("start") + F.col("e_size")) / F.col("e_target")
    n = int(min(MOST_PARTITIONS, max(1, words // PARTITION_WORDS)))
    out = out.select("row", "source", "key", finish.alias("finish"))
    slot = F.least(F.floor(F.col("finish") * n), F.lit(n - 1)).cast("int")
    out = out.repartitionById(n, slot).sortWithinPartitions("finish", F.col("source").asc_nulls_last(), "key")
    return out.select("row.*")
