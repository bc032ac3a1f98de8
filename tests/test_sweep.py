"""Sweeps across partitions against sequential ones."""

import random

import pytest
from pyspark.sql import functions as F

from locusmill.operators import chunks, intervals, select, sweep
from locusmill.plans import queries as Q


@pytest.fixture
def many(spark):
    """More partitions than rows of some groups, so that groups cross borders."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def sequential(rows):
    out = []
    for g, s, e in sorted(r for r in rows if None not in r[1:]):
        if out and out[-1][0] == g and s <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
            out[-1][3] += 1
        else:
            out.append([g, s, e, 1])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("seed,groups,reach", [(0, 1, 30), (1, 1, 2000), (2, 3, 5), (3, 40, 50), (4, 1, 10**6)])
def test_windows_of_one_chromosome_equal_a_sequential_sweep(many, seed, groups, reach):
    rng = random.Random(seed)
    rows = [(f"c{rng.randrange(groups)}", s := rng.randrange(20_000), s + rng.randrange(reach) * (rng.random() < 0.5)) for _ in range(1500)]
    rows += rng.choices(rows, k=60) + [("c0", None, 5), ("c0", 7, None)]
    df = many.createDataFrame(rows, "chromosome string, start int, end int")
    got = intervals.merge_windows(df).collect()
    assert sorted(tuple(r) for r in got) == sequential(rows)


def test_a_chromosome_is_swept_by_all_tasks(many):
    df = many.range(2000).select(F.lit("c").alias("chromosome"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 12).alias("end"))
    parts = sweep.in_ranges(df, ["chromosome", "start", "end"]).groupBy(sweep.PART).count().collect()
    assert len(parts) == 13 and max(r["count"] for r in parts) < 2000 / 13 * 2
    assert [tuple(r) for r in intervals.merge_windows(df).collect()] == [("c", 0, 2000 * 10 + 2, 2000)]
    assert intervals.merge_windows(df.limit(0)).count() == 0


def test_null_group_is_a_group(many):
    df = many.createDataFrame([(None, i, i + 1) for i in range(40)] + [("a", 0, 1), ("a", 5, 6)], "chromosome string, start int, end int")
    assert sorted((tuple(r) for r in intervals.merge_windows(df).collect()), key=repr) == sorted([(None, 0, 40, 40), ("a", 0, 1, 1), ("a", 5, 6, 1)], key=repr)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_equal_brute_force(many, by):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.choice([None, *range(40)]) if rng.random() < 0.5 else rng.random() * 40) for _ in range(900)]
    rows = [(g, None if v is None else float(v), i) for i, (g, v) in enumerate(rows)]
    got = {r.i: r["rank"] for r in select.average_rank(many.createDataFrame(rows, "g string, v double, i int"), "v", by).collect()}
    for g, v, i in rows:
        own = [x[1] for x in rows if x[1] is not None and (not by or x[0] == g)]
        assert got[i] == (None if v is None else sum(x < v for x in own) + (sum(x == v for x in own) + 1) / 2)


def test_ranks_of_all_rows_are_in_no_single_task(many):
    plan = select.average_rank(many.range(1000).withColumn("v", F.rand(1)), "v")._jdf.queryExecution().executedPlan().toString()
    # Without a group, only one number per range is swept in one place.
    top = plan.split("Exchange SinglePartition")
    assert len(top) <= 2 and ("HashAggregate(keys=[__part" in top[-1] if len(top) == 2 else True)


def test_row_numbers_across_ranges(many):
    rng = random.Random(2)
    rows = [(k, "x" * 50) for k in rng.sample(range(10**6), 3000)]
    got = {r.k: r.row for r in chunks.numbered(many.createDataFrame(rows, "k int, wide string"), ["k"]).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(k for k, _ in rows))}


def test_running_sums_and_maxima(many):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(-50, 50)) for i in range(800)]
    df = many.createDataFrame(rows, "g string, i int, v int")
    for how, start in (("sum", 0), ("max", None)):
        got = {r.i: r.out for r in sweep.running(df, ["g"], ["i"], "v", how, "out").collect()}
        state = {}
        for g, i, v in rows:
            assert got[i] == state.get(g, start)
            state[g] = (state.get(g, 0) + v) if how == "sum" else max(v, state.get(g, v))


@pytest.mark.parametrize("q", [0.0, 0.3, 0.75, 1.0])
def test_quantiles_are_exact(many, q):
    import numpy as np

    rng = random.Random(8)
    rows = [(g, float(rng.randrange(30)) if rng.random() < 0.5 else rng.random() * 30) for g in "abc" for _ in range(rng.randint(1, 200))] + [("a", None), ("none", None)]
    got = {r.g: r.q for r in sweep.quantiles(many.createDataFrame(rows, "g string, v double"), ["g"], "v", q, "q").collect()}
    assert set(got) == set("abc")
    for g in got:
        assert got[g] == pytest.approx(np.quantile([v for h, v in rows if h == g and v is not None], q), abs=1e-12)
    whole = sweep.quantiles(many.createDataFrame(rows, "g string, v double"), [], "v", q, "q").first()[0]
    assert whole == pytest.approx(np.quantile([v for _, v in rows if v is not None], q), abs=1e-12)


def test_trimmed_factors_equal_the_kernel(many):
    """The sweeps' factors against the kernel that takes a sample's whole column."""
    import numpy as np

    from locusmill.functions import kernels
    from locusmill.operators import crossval

    rng = np.random.default_rng(3)
    x = rng.poisson(rng.gamma(1, 20, 300)[:, None] * np.array([1, 2, 0.5, 1.5])) + 0.0
    x[:, 3] = x[:, 0] * 2
    counts = many.createDataFrame([(f"g{i}", f"s{j}", float(x[i, j])) for i in range(300) for j in range(4)], "phenotype_id string, sample_id string, value double")
    size = counts.groupBy("sample_id").agg(F.sum("value").alias("size"))
    got = {r.sample_id: r.raw for r in crossval.trimmed_factors(counts, size, "s0", float(x[:, 0].sum())).collect()}
    for j in range(4):
        assert got[f"s{j}"] == pytest.approx(kernels.tmm_to_reference(x[:, [j, 0]]), rel=1e-9)
    assert got["s3"] == 1.0 and crossval.normalised_counts(counts.limit(0)).count() == 0


def test_registered_sweeps_use_it():
    assert {"merge_windows", "rank_average", "chunk_assign", "running_load"} <= set(Q.QUERIES)
