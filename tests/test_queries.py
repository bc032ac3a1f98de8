"""Every registered query against its DuckDB SQL on the driver's tables."""

import duckdb
import pytest

from locusmill.plans import file_queries, workflow_queries  # noqa: F401  (these register their queries)
from locusmill.plans import queries as Q

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(Q.SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(dict(zip(names, row))[c] for c in columns)) for row in found.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert not Q.QUERIES[name](spark, SF).isEmpty()


def test_fold_pcs_covers_the_whole_table(spark):
    samples = {str(r.vec_id) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect()}
    rows = Q.fold_pcs(spark, SF).select("sample_id", "split").collect()
    assert {r.sample_id for r in rows} == samples and {r.sample_id for r in rows if r.split == "test"} == samples


def test_planted_traits_are_rows_of_the_table(spark):
    """A cohort's dosages stay with the tasks: as literals of the plan they pass the driver, one by one."""
    traits, _ = Q.planted_traits(spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    plan = traits._jdf.queryExecution().optimizedPlan().toString()
    assert "embeddings" in plan or "embedding#" in plan
    assert {r.phenotype_id: len(r["values"]) for r in traits.collect()} == {"t1_ENSG1.1": n, "t2_ENSG2.1": n}


def test_region_filter_reaches_the_scan(spark):
    plan = Q.phenotype_match_exact(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#13)]" in plan


def test_overlap_join_is_keyed_by_bin(spark):
    plan = Q.overlap_left_join(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "__bin" in plan


def test_annotation_computes_before_its_copies(spark):
    """Overlaps make far more copies than rows: nothing is computed for each copy, and a task holds those of one loop."""
    plan = Q.QUERIES["workflow_annotate"](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    loops = [i for i, x in enumerate(plan) if "explode(sequence(1, __" in x]
    assert len(loops) == 2 and any("Repartition" in x and "false" in x for x in plan[loops[0] : loops[1]])
    assert all("round(" not in x and "CASE" not in x for x in plan[: loops[1] + 1]) and any("round(" in x for x in plan)


def test_entry_imports_and_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
