import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from locusmill.llm import exact_dedup, near_copies, simhash

SF = "/root/testdata/sf0.01"


def brute_groups(rows):
    import re

    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    out = {}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        out[i] = (min(same), len(same), i == min(same))
    return out


TEXTS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (1, ""), (2, None), (7, "\n \n"), (8, " "), (4, "a b"), (11, "é"), (12, "é"), (13, "x" * 300_000), (14, "x" * 300_000)]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: (F.crc32(t.cast("binary")) % 2).cast("string")])
def test_groups_equal_brute_force(make, digest):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(make(*TEXTS), digest=digest).collect()}
    assert got == brute_groups(TEXTS)


def test_hot_group_goes_by_broadcast(make):
    rows = [(i, "same") for i in range(1500)] + [(i, f"t{i}") for i in range(1500, 1600)]
    got = exact_dedup.exact_groups(make(*rows)).groupBy("keep_id", "group_size").count().orderBy("keep_id").collect()
    assert tuple(got[0]) == (0, 1500, 1500) and len(got) == 101


def test_null_ids_repeats_empty_table_and_extra_columns(make, spark):
    rows = make((None, "x"), (1, "x"), (1, "x"), (None, "y")).withColumn("digest", F.lit(1)).withColumn("id", F.lit(2))
    kept = exact_dedup.drop_exact_copies(rows)
    assert kept.columns == rows.columns and sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "y"), (1, "x")]
    assert sorted((r.doc_id or -1, r.kept) for r in exact_dedup.exact_groups(rows).collect()) == [(-1, False), (-1, True), (1, False), (1, True)]
    assert exact_dedup.exact_groups(make().limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_one_row_of_each_text_stays_whatever_the_ids(make, seed):
    """Repeated and null ids against brute force: no text is lost, one row of each stays, and it has the smallest id."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice(["a", "b ", "b\t", "c d", None, ""])) for _ in range(40)]
    if seed == 2:
        rows = [(1, "x"), (1, "y"), (0, "y")] + [(None, "z")] * 3
    norm = lambda t: __import__("re").sub(r"[\x20\x09-\x0D]+", " ", t or "")
    least = {}
    for i, t in rows:
        k = norm(t)
        least[k] = i if k not in least or least[k] is None or (i is not None and i < least[k]) else least[k]
    kept = exact_dedup.drop_exact_copies(make(*rows)).collect()
    assert sorted((norm(r.text), r.doc_id or 0) for r in kept) == sorted((k, i or 0) for k, i in least.items())


def test_exact_query_equals_sql(spark):
    import duckdb

    from locusmill.llm.queries import ORACLE_SQL, op9_exact_dedup

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ORACLE_SQL['op9_exact_dedup']})").fetchall())
    assert sorted(map(tuple, op9_exact_dedup(spark, SF).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())) == want


# ---------------------------------------------------------------- SimHash
def brute_fingerprint(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, bits=3):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i + 1, len(values)):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_values(n, seed, centres=8, flips=5):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        v = rng.choice(base)
        for _ in range(rng.randint(0, flips)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


def test_fingerprints_equal_brute_force():
    for t in [None, "", " \n", "A b", "One TWO three", "É É é a b c d", "w " * 40_000, "a b c a b c a b c"]:
        assert simhash.fingerprint(t or "") == brute_fingerprint(t), t


@pytest.mark.parametrize("seed", range(4))
def test_trie_components_equal_brute_force(seed):
    values = near_values(300, seed)
    got = simhash.trie_components(np.array(values, np.uint64), np.array([0, len(values)]), 3, small=4, chunk=64)
    assert got.tolist() == brute_components(values)


@pytest.mark.parametrize("split", [200_000, 20])
def test_links_connect_the_same_fingerprints(spark, split):
    values = near_values(400, 7)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 3, split=split)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    brute = brute_components(values)
    groups, mine = {}, {}
    for v, s, b in zip(values, signed, brute):
        groups.setdefault(b, set()).add(s)
        mine.setdefault(got.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
    assert links.count() < 4 * len(values)


def test_groups_equal_brute_force_on_documents(make):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [base, base + " tail", base.upper(), "", None, "  ", "short text", "short TEXT", "other thing here", base.replace("word7 ", "wort7 ")]
    rows = list(enumerate(texts, start=3))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_groups(make(*rows)).collect()}
    values = [brute_fingerprint(t) for _, t in rows]
    want = {i: (f"{v:016x}", rows[c][0]) for (i, _), v, c in zip(rows, values, brute_components(values))}
    assert got == want


def test_near_dedup_edges(make):
    docs = make((4, "a b c d"), (2, "A B C D"), (None, "a b c d"), (9, "quite other words")).withColumn("fp", F.lit("x"))
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1) for r in kept.collect()) == [2, 9]
    assert simhash.near_groups(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_one_row_of_each_near_group_stays_whatever_the_ids(make, seed):
    rng = random.Random(seed)
    texts = ["a b c d", "A B C D", "quite other words here", "and more of them still", None, ""]
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(texts)) for _ in range(30)]
    groups = {t: brute_fingerprint(t) for t in texts}
    least = {}
    for i, t in rows:
        g = groups[t]
        least[g] = i if g not in least or least[g] is None or (i is not None and i < least[g]) else least[g]
    kept = simhash.drop_near_copies(make(*rows)).collect()
    assert sorted((groups[r.text], r.doc_id or 0) for r in kept) == sorted((g, i or 0) for g, i in least.items())


def test_groups_of_the_table_equal_brute_force(spark):
    """The registered query on the whole table."""
    from locusmill.llm.queries import op4_simhash

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    values = [brute_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{v:016x}", ids[c]) for i, v, c in zip(ids, values, brute_components(values))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, SF).collect()} == want


# ---------------------------------------------------------------- near copies at a similarity
def shingle_set(text, k=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), int(share * len(out))):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def edited_corpus(seed, families=120):
    """Families of a text and edited copies of it, over a range of similarities, beside texts of their own."""
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(120, 500))]
        rows.append(" ".join(base))
        rows += [" ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.1]))) for _ in range(2)]
    rows += [" ".join(f"w{rng.randrange(3000)}" for _ in range(200)) for _ in range(200)]
    return rows


def near_sets(frame):
    rows, classes = frame
    out = {}
    for r in rows.join(classes, "node").select("id", "component_id").collect():
        out.setdefault(r.component_id, set()).add(r.id)
    return {i: c for c, own in out.items() for i in own}


@pytest.mark.parametrize("split", [20_000, 3])
def test_near_copies_at_a_similarity(make, split):

    texts = edited_corpus(1)
    sets = [shingle_set(t) for t in texts]
    of = near_sets(near_copies.near_copies(make(*texts), split=split))
    near, apart = [], []
    for f in range(120):
        for a, b in ((0, 1), (0, 2), (1, 2)):
            j = jaccard(sets[3 * f + a], sets[3 * f + b])
            (near if j >= 0.8 else apart).append((j, of[3 * f + a] == of[3 * f + b]))
    assert len(near) > 150 and sum(x for _, x in near) / len(near) >= 0.95
    assert not any(x for j, x in apart if j < 0.5)
    assert all(of[i] == i for i in range(360, 560)) and all(of[i] // 3 == i // 3 for i in range(360))


def test_near_copies_of_the_table(spark):
    """Recall at a similarity of 0.8 over five words and clean texts left alone, against exact similarities of all pairs."""

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets, first = {}, {}
    for i, t in sorted(texts.items()):
        sets[first.setdefault(frozenset(shingle_set(t)), i)] = shingle_set(t)
    by = {}
    for i, own in sets.items():
        for x in sorted(map(hash, own))[: len(own) // 5 + 1]:  # in a common order of shingles, pairs of 0.8 share one of these
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for own in by.values() if len(own) < 400 for k, a in enumerate(own) for b in own[k + 1 :]}
    size = {i: len(x) for i, x in sets.items()}
    scored = {(a, b): jaccard(sets[a], sets[b]) for a, b in pairs if 10 * min(size[a], size[b]) >= 7 * max(size[a], size[b])}
    of = near_sets(near_copies.near_copies(docs))
    near = [(p, j) for p, j in scored.items() if j >= 0.8]
    caught = sum(of[a] == of[b] for (a, b), _ in near)
    print(f"near copies of the table: {caught} of {len(near)} pairs")
    assert len(near) > 30 and caught >= 0.9 * len(near), (caught, len(near))
    best = {}
    for (a, b), j in scored.items():
        best[a], best[b] = max(best.get(a, 0), j), max(best.get(b, 0), j)
    alone = [i for i in sets if best.get(i, 0) < 0.7]
    members = {}
    for i in sets:
        members.setdefault(of[i], []).append(i)
    assert sum(len(members[of[i]]) > 1 for i in alone) <= 0.001 * len(alone)


def test_near_copies_edges(make):

    docs = make((4, "a b c d"), (2, "A B  C D"), (None, "a b c d"), (2, "quite other words"), (None, None), (7, ""), (8, " \n")).withColumn("fp", F.lit("x")).withColumn("node", F.lit(1)).withColumn("id", F.lit(2)).withColumn("h1", F.lit(0)).withColumn("__row", F.lit(0))
    kept = near_copies.drop_similar(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1, (r.text or "").strip()[:1]) for r in kept.collect()) == [(2, "A"), (2, "q"), (7, "")]
    assert near_copies.drop_similar(docs.limit(0)).count() == 0
    again = make((1, "same words stand here now"), (1, "same words stand here now"))
    assert near_copies.drop_similar(again).count() == 1


def test_a_large_family_is_dealt_to_chunks(make):

    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    family = [" ".join(edited(rng, base, 0.003)) for _ in range(300)]
    of = near_sets(near_copies.near_copies(make(*family), split=40))
    assert set(of.values()) == {0}
    # A shared passage, and nothing else in common: many minima shared, no near copies.
    apart = [" ".join(base[:40] + [f"x{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(150)]
    of = near_sets(near_copies.near_copies(make(*apart), split=10, bits=40))
    assert all(of[i] == i for i in of)


def test_links_that_no_first_text_of_a_part_has_are_found(spark):
    """Two heaps of copies hang together by one link between two of their texts, which lie in different parts and come first in hardly any."""
    rng, rows, heaps = np.random.default_rng(3), [], 4
    for k in range(heaps):
        for changed in [0] * 40 + [40, 80] + [120] * 40:  # of 256 lanes; 40 apart is a link, 80 is none
            lanes = np.full(near_copies.LANES, k, np.uint16)
            lanes[:changed] = 100 + k
            rows.append((int(rng.integers(1 << 60)), k, [k] * near_copies.ALL_MINIMA, lanes.tobytes()))
    found = near_copies.near_links(spark.createDataFrame(rows, "node long, fp long, minima array<long>, sketch binary"), 1, 0.775, 20)
    top = {r[0]: r[0] for r in rows}

    def end(x):
        while top[x] != x:
            x = top[x]
        return x

    for r in found.collect():
        top[end(r.u)] = end(r.v)
    of = [{end(r[0]) for r in rows if r[1] == k} for k in range(heaps)]
    assert all(len(x) == 1 for x in of) and len(set.union(*of)) == heaps


def test_no_group_is_larger_than_split(make):
    """Texts that share most words: groups of minima, and of pairs and more of them, are parted until none has more than split."""
    rng = random.Random(4)
    shared = " ".join(f"common{i}" for i in range(200))
    rows = [(i, f"{shared} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for i in range(600)]
    signed = near_copies.materialise(near_copies.signatures(make(*rows), "doc_id", "text", 5))
    nodes = signed.select("node", "fp", "minima").where("minima is not null")
    members, whole = near_copies.groups_of(nodes, 50)
    largest = members.groupBy("g").count().agg(F.max("count")).first()[0] or 0
    assert largest <= 50
    # Whatever is larger is a family, and families above the split are dealt to chunks.
    assert whole.isEmpty() or whole.groupBy("g").count().agg(F.min("count")).first()[0] > 50


def test_texts_that_share_one_hot_minimum_meet(make):
    """Every pair at the similarity meets in some group or family, though the first four minima are hot for nearly all."""
    rng = random.Random(9)
    shared = [f"common{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = [f"w{i}x{k}" for k in range(60)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[:-2] + [f"z{i}", f"y{i}"]))]
    rng.shuffle(rows)
    signed = near_copies.materialise(near_copies.signatures(make(*rows), "doc_id", "text", 5))
    members, whole = near_copies.groups_of(signed.select("node", "fp", "minima"), 40)
    groups = members.select("node", "g").unionByName(whole)
    by_id = {r.id: r.node for r in signed.collect()}
    own = {}
    for r in groups.collect():
        own.setdefault(r.node, set()).add(r.g)
    assert all(own[by_id[2 * i]] & own[by_id[2 * i + 1]] for i in range(150))
