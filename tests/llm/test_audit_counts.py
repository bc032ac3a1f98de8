import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import divergence, token_counts
from locusmill.llm.queries import BYTE_BPE, ORACLE_SQL, QUERIES, WORD_BPE, tokenizer_path

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- divergence of sources
def brute_audit(rows, top=200):
    """By definition; rows: (text, lang, source)."""
    docs = [(lang or "", source or "", re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().translate(divergence._FOLD))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in seen if seen[t] >= 3]
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if seen[t] >= 3) for s in {d[1] for d in own}}
        total = sum(counts.values(), Counter())

        def share(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s)
            terms = sorted((-f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms)]
    return sorted(out)


def audited(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["Éa", "éa", "a", "b", "c'd", "ZZ", "zz", "x1y", "ß", "中文", "__", "[q]", "{r}", "@s`t"]
    return [(" ".join(rng.choices(words, k=rng.randint(0, 9))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", "é", None])) for _ in range(n)]


@pytest.mark.parametrize("seed,slice_terms,wave_bytes", [(0, 5, 1), (1, 1, 200), (2, 200_000, 1 << 20)])
def test_audit_equals_definition(make, seed, slice_terms, wave_bytes):
    """Slices of few terms and waves of one round give the same exact integers."""
    rows = [*random_rows(seed), ("once only", "xx", "a"), ("never again", "xx", "b"), (None, "xx", None), ("one source", "yy", "a")]
    docs = make(*[(i, t, lang, s) for i, (t, lang, s) in enumerate(rows)])
    got = audited(divergence.audit(docs, top=4, slice_terms=slice_terms, wave_bytes=wave_bytes))
    assert got == brute_audit(rows, 4)
    assert {r[4] for r in got if r[0] == "xx" and r[2] == "pair"} == {0} and not [r for r in got if r[0] == "yy"]


def test_audit_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op11_divergence"]).fetchall()
    assert audited(QUERIES["op11_divergence"](spark, SF)) == sorted(want)


def test_audit_edges(make, spark):
    assert divergence.audit(make()).count() == 0
    # Repeated and null ids, ties by bytes, clashing columns, one very long text.
    rows = [(None, "tie Tie", "en", "a"), (1, "tie", "en", "b"), (1, "tie", "en", "b"), (2, "z é " * 30_000, "en", "c"), (3, "z é", "en", "a"), (4, "é z", "en", "b")]
    docs = make(*rows).withColumns({c: F.lit(1) for c in ("term", "slice", "seat", "host", "n", "item", "value", "rank", "total")})
    got = audited(divergence.audit(docs))
    assert got == brute_audit([r[1:] for r in rows])
    tied = [r for r in got if r[:3] == ("en", "c", "term")]
    assert [r[3] for r in tied] == ["z", "é"] and tied[0][4] == tied[1][4]


def test_every_pair_of_seats_meets_once(spark):
    """The tournament by itself: for any number of seats each pair has one traveller, and hosts share the work."""
    for n in (1, 2, 3, 6, 7, 12):
        even = n + n % 2
        seats = spark.createDataFrame([("l", 0, f"s{i}", i, n, even) for i in range(n)], "lang string, slice int, source string, seat int, seats int, even int")
        met = [(int(r.source[1:]), r.host) for first in range(0, even - 1, 2) for r in divergence._arrivals(seats, first, first + 2).collect()]
        assert sorted(tuple(sorted(p)) for p in met) == [(i, j) for i in range(n) for j in range(i + 1, n)]
        if n > 3:
            assert max(Counter(h for _, h in met).values()) <= n // 2 + 1


def test_only_travellers_are_shuffled(spark):
    """A wave's plan has one exchange: the residents keep their partitioning."""
    cols = "lang string, slice int, source string, size int, terms binary, counts binary, total long, seat int, seats int, even int"
    vectors = spark.createDataFrame([("l", 0, "a", 1, None, None, 5, 0, 2, 2), ("l", 0, "b", 1, None, None, 5, 1, 2, 2)], cols)
    resident = vectors.drop("seats", "even").repartition(4, "lang", "slice", "seat").persist()
    assert resident.count() == 2
    wave = resident.groupBy("lang", "slice", "seat").cogroup(divergence._arrivals(vectors, 0, 1).groupBy("lang", "slice", "host")).applyInArrow(divergence._meet, divergence._PAIR)
    plan = wave._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ENSURE_REQUIREMENTS") == 1 and len(wave.collect()) == 2
    resident.unpersist()


def test_shares_are_exact():
    rng = random.Random(5)
    for total in (1, 7, 10**6 + 3, 10**12 + 39, 8 * 10**15 + 1, 10**17 + 3):
        counts = [0, total - 1, *(rng.randrange(total) for _ in range(200))]
        assert divergence.shares(np.array(counts, np.int64), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


# ---------------------------------------------------------------- token counts
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def counted(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()), key=repr)


def test_token_counts_of_the_table_equal_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 1024) for r in rows]
    assert counted(QUERIES["op12_token_counts"](spark, SF)) == sorted(want, key=repr)


#: Signs around which a cut could go wrong: white space of several kinds, contractions, special strings, scripts.
SIGNS = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "᠎", " ", "​", "　", "﻿", "a", "b1", "'s", "'", "'ll", "S", "12", ".", "!?", "<|endoftext|>", "<|", "é", "文。", "か", "́", "😀", "\x00", "힣", "x" * 30, "_", "Ⅷ", "²"]


@pytest.mark.parametrize("seed", range(3))
def test_cuts_keep_the_tokens(library, seed):
    rng = random.Random(seed)
    counter = token_counts.Counter(tokenizer_path(BYTE_BPE), batch_bytes=50)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 14))) for _ in range(4000)]
    want = [library(t) for t in texts]
    assert counter.cuts and counter.count(texts) == want
    for text, n in zip(texts, want):
        chunks = list(token_counts.SafeCuts.chunks(text, rng.randint(1, 6)))
        assert "".join(chunks) == text and sum(map(library, chunks)) == n


def test_long_texts_leave_in_chunks(make, spark, library):
    """Small bounds: long texts go through chunks, with and without white space, and count as the library has it."""
    rng = random.Random(8)
    texts = ["".join(rng.choices(SIGNS, k=3000)), "wort " * 5000, "a" * 20_000, "文。" * 4000, "ab1" * 5000, " " * 9000, "short", "", None]
    docs = make(*texts, (6, "again short"), (None, "no id " * 900)).withColumns({c: F.lit("x") for c in ("id", "uid", "chunk", "n_tokens", "n_bytes")})
    got = counted(token_counts.count_tokens(docs, tokenizer_path(BYTE_BPE), batch_bytes=2000, chunk_bytes=500, long_bytes=3000, limit=100))
    rows = [*enumerate(texts), (6, "again short"), (None, "no id " * 900)]
    want = [(i, len((t or "").encode()), library(t), library(t) > 100) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(make(), tokenizer_path(BYTE_BPE)).count() == 0


def test_chunks_are_even():
    sizes = [len(c) for c in token_counts.SafeCuts.chunks("some words of a text " * 9000, 1000)]
    assert max(sizes) <= 1000 and min(sizes[:-1]) > 900


def test_a_tokenizer_of_another_kind_gets_whole_texts(make):
    from tokenizers import Tokenizer

    path = tokenizer_path(WORD_BPE)
    assert not token_counts.SafeCuts.fit(path)
    own = Tokenizer.from_file(path)
    text = "Some Words, <|endoftext|> and more. " * 50
    row = token_counts.count_tokens(make(text), path, long_bytes=10).first()
    assert row.n_tokens == len(own.encode(text, add_special_tokens=False).ids)


def test_no_word_of_the_new_operators_is_taken_from_the_driver():
    """Neither collects rows of documents: the only first() is of one aggregate."""
    for module in (divergence, token_counts):
        source = Path(module.__file__).read_text()
        assert "collect()" not in source and "toPandas" not in source and "toLocalIterator" not in source
