"""Connected components of credible sets that share variants."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored, stored_with_count


#: So many edges (both ways) are no more than one task's work.
ONE_TASK = 200_000


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Each round points every node to the smallest of its neighbours and itself, follows the pointers
    to their ends (each step doubles their reach) and contracts the edges to these ends, the local
    minima. Of two neighbours one at most is a local minimum, so the nodes at least halve each round
    and neither rounds nor steps need a bound; what the rounds found is put together backwards.
    Every step is written to the shared folder. Once ONE_TASK edges or fewer are left, one task
    finishes them. Tables of nodes are joined by shuffles: Spark would judge them by the size of their
    compressed files and send what is a hundred times as much in memory through the driver.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    both, n = stored_with_count(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), F.lit(True))
    maps: list[DataFrame] = []
    while n or not maps:
        if n <= ONE_TASK:
            maps.append(_at_once(both))
            break
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("up"), F.count(F.lit(1)).alias("degree"))
        step, moving = stored_with_count(near, F.col("u") != F.col("up"))
        while moving:
            step, moving = stored_with_count(_ahead(step), F.col("moved"))
        maps.append(step.select("u", "up"))
        both, n = stored_with_count(_relabelled(_relabelled(both, step, "u", n), step, "v", n).where("u <> v").distinct(), F.lit(True))
    out = maps.pop()
    while maps:
        ahead = out.select(F.col("u").alias("up"), F.col("up").alias("top"))
        out = _salted(maps.pop(), ahead, "up", "u").select("u", F.coalesce("top", "up").alias("up"))
    return out.select(F.col("u").alias("node"), F.col("up").alias("component"))


def _at_once(both: DataFrame) -> DataFrame:
    """(u, up): the smallest node reachable, found by one task; both has at most ONE_TASK rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def end(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for pdf in frames:
            for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist()):
                up.setdefault(a, a), up.setdefault(b, b)
                a, b = end(a), end(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
        yield pd.DataFrame({"u": list(up), "up": [end(x) for x in up]})

    kind = both.schema["u"].dataType.simpleString()
    return both.coalesce(1).mapInPandas(run, f"u {kind}, up {kind}")


def _ahead(step: DataFrame) -> DataFrame:
    """Every pointer followed by the one at its end; whether it moved. The least node of many is a hot key, so the join is salted."""
    ends = step.where("u <> up").select(F.col("u").alias("up"), F.col("up").alias("further"))
    return _salted(step, ends, "up", "u").select("u", F.coalesce("further", "up").alias("up"), "degree", F.col("further").isNotNull().alias("moved"))


def _relabelled(both: DataFrame, step: DataFrame, end: str, n: int, hot_keys: int = 2000, least: int = 10_000) -> DataFrame:
    """The `n` edges with `end` sent on by `step`; nodes of over n / hot_keys edges, at most hot_keys of them, go by broadcast."""
    hot = F.col("degree") > max(least, n // hot_keys)
    table = step.select(F.col("u").alias("__n"), "up", "degree")
    columns = [F.col("up").alias(end), "v" if end == "u" else "u"]
    first = both.join(F.broadcast(table.where(hot).drop("degree")), F.col(end) == F.col("__n"), "left")
    cold = first.where("up is null").select("u", "v").join(table.where(~hot).drop("degree").hint("merge"), F.col(end) == F.col("__n"))
    return first.where("up is not null").select(*columns).unionByName(cold.select(*columns))


def _salted(rows: DataFrame, table: DataFrame, key: str, by: str, salts: int = 8) -> DataFrame:
    left = rows.withColumn("__salt", F.pmod(F.hash(by), F.lit(salts)))
    right = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [key, "__salt"], "left").drop("__salt")


def set_components(sets: DataFrame, min_z: float = 3.0, max_size: int = 10) -> DataFrame:
    """Members of credible sets that share variants, with component and the variant of largest pip in it.

    sets: cs_id, molecular_trait_id, group, variant, chromosome, position, z, pip, cs_size. A set
    counts if its largest |z| passes `min_z` and it is smaller than `max_size`. Sets of a group at
    one position hang together; a chain through each position's sets suffices for that, where all
    pairs would grow with the square of their number.
    """
    strong = sets.groupBy("cs_id").agg(F.max(F.abs("z")).alias("max_abs_z"))
    kept = sets.join(strong.hint("merge"), "cs_id").where((F.col("max_abs_z") > min_z) & (F.col("cs_size") < max_size))
    hubs = kept.groupBy("group", "chromosome", "position").agg(F.min("cs_id").alias("hub"))
    edges = kept.join(hubs, ["group", "chromosome", "position"]).select(F.col("cs_id").alias("u"), F.col("hub").alias("v")).distinct()
    parts = connected_components(edges)
    out = kept.join(parts.hint("merge"), kept["cs_id"] == parts["node"], "left").drop("node")
    top = top_of_component(out, "component", "variant", "pip").withColumnRenamed("top", "top_variant")
    return out.join(top, "component", "left")


def top_of_component(members: DataFrame, component: str, item: str, value: str) -> DataFrame:
    """(component, top): the item of the largest value in each component, ties by item."""
    return members.groupBy(component).agg(F.max_by(item, F.struct(value, item)).alias("top"))
