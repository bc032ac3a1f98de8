import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import html_extract, mixing, piece_sampling, token_planes
from locusmill.llm.queries import PIECE_BPE, WORD_BPE, tokenizer_path

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- mixing
def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = budget / sum(w[s] for s in open_)
        above = {s for s in open_ if w[s] * level > most * sizes[s]}
        if not above:
            target |= {s: w[s] * level for s in open_}
            break
        for s in above:
            target[s] = most * sizes[s]
            budget -= target[s]
        open_ -= above
    return target


def test_targets_and_takes(make):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 13)), "en", [None, "b", "a", "c", "é", "tiny"][min(i % 7, 5)] if i % 50 else "tiny") for i in range(900)] + [(1000, None), (1001, "")]
    docs = make(*rows)
    got = mixing.mix_plan(docs).collect()
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    source = {i: s for i, t, _, s in (r if len(r) == 4 else (*r, "en", "a") for r in rows)}
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    target = brute_targets(dict(sizes))
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
    assert all(abs(taken[s] - target[s]) <= 13 for s in sizes) and sum(taken.values()) <= 1.5 * sum(sizes.values())


def brute_mix(rows, order, weights=(3, 1, 2), share=1.5, most=2):
    """The queue by definition: every copy of every row in one global order of finish times, cut at the budget.

    rows: (id, text, source); order: the operator's order key by (id, text). Returns words taken by (id, text, source).
    """
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target, queue = brute_targets(dict(sizes), weights, share, most), []
    for s in sizes:
        own = sorted(((order[i, t], i, t) for i, t, r in rows if r == s and size(t)), key=lambda x: x[0])
        for again in range(most):
            at = again * sizes[s]
            for k, i, t in own:
                at += size(t)
                if target[s] > 0:
                    queue.append((at / target[s], s is None, s or "", k, again, i, t, s))
    taken, total, budget = Counter(), 0, sum(target.values())
    for f, *_, i, t, s in sorted(queue, key=lambda q: q[:5]):
        if total + size(t) > budget + 1e-6:
            break
        total += size(t)
        taken[i, t, s] += size(t)
    return taken, target


def mix_order(docs, seed=17):
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", F.xxhash64(text), F.lit(seed)).alias("k"))
    return {(r.doc_id, r.text): r.k for r in keyed.collect()}


def mix_rows(seed):
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(250):
        source = rng.choice(["a", "a", "a", "b", "c", "é", None, "d"]) if seed else "abc"[i % 3]
        text = " ".join(["w"] * rng.choice([0, 1, 3, 7, 40])) + ("" if seed == 1 else f" x{i}")
        rows.append((rng.choice([None, 1, 2, 3, i]) if seed == 1 else i, None if rng.random() < 0.05 else text, "en", source))
    return rows + ([(7, "same words here", "en", "a")] * 60 if seed == 1 else [])


@pytest.mark.parametrize("seed", range(4))
def test_mix_equals_the_queue_by_definition(make, seed, monkeypatch):
    if seed == 3:
        monkeypatch.setattr(mixing, "PER_BUCKET", 2)
        monkeypatch.setattr(mixing, "AT_ONCE", 1)
        monkeypatch.setattr(mixing, "SLICES", 3)
    rows = mix_rows(seed)
    docs = make(*rows)
    taken, target = brute_mix([(i, t, s) for i, t, _, s in rows], mix_order(docs))
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows) and {round(r.target, 6) for r in plan} == {round(x, 6) for x in target.values()}
    words = lambda t: len((t or "").split())
    assert sum(r.taken for r in plan) == sum(taken.values())
    by_id, want = Counter(), Counter()
    for r in plan:
        by_id[r.doc_id, r.size] += r.taken
    for (i, t, _), n in taken.items():
        want[i, words(t)] += n
    assert +by_id == want and all(r.taken <= 2 * r.size for r in plan)
    # What mix hands over is the plan, word for word, in the order of the finish times.
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id, r.text, r.source] += words(r.text)
    assert got == taken


def test_mix_is_ranged_by_finish_time(make, monkeypatch):
    monkeypatch.setattr(mixing, "PARTITION_WORDS", 300)
    rows = [(i, " ".join(["w"] * (1 + i % 9)) + f" x{i}", "en", "abc"[i % 3]) for i in range(400)]
    docs = make(*rows)
    order, sizes = mix_order(docs), Counter()
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    target, finish = brute_targets(dict(sizes)), {}
    for s in sizes:
        at = 0
        for k, i, t in sorted((order[i, t], i, t) for i, t, _, r in rows if r == s):
            at += len(t.split())
            finish[i] = [at / target[s], (at + sizes[s]) / target[s]]
    mixed = mixing.mix(docs)
    assert mixed.rdd.getNumPartitions() > 3
    last, seen = 0.0, Counter()
    for r in mixed.collect():
        f = finish[r.doc_id][seen[r.doc_id]]
        seen[r.doc_id] += 1
        assert f >= last
        last = f


def test_mix_edges(make):
    docs = make((1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (2, "d", "en", "y"), (None, "e f", "en", None)).withColumn("size", F.lit("own")).withColumn("key", F.lit(1)).withColumn("__n", F.lit(2)).withColumn("row", F.lit(3))
    plan = mixing.mix_plan(docs).agg(F.sum("taken")).first()[0]
    out = mixing.mix(docs)
    assert out.columns == docs.columns and sum(len(r.text.split()) for r in out.collect()) == plan
    assert mixing.mix_plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix_plan(make(None, "")).agg(F.sum("taken")).first()[0] == 0 and mixing.mix(make(None, "")).count() == 0
    hot = make(*[(None, "same words here", "en", "x")] * 35, *[(i, f"w{i} b", "en", "y") for i in range(30)])
    planned = mixing.mix_plan(hot)
    assert sum(len(r.text.split()) for r in mixing.mix(hot).collect()) == planned.agg(F.sum("taken")).first()[0]
    longest = make((1, "w " * 300_000, "en", "x"), (2, "a b", "en", "y"))
    assert mixing.mix_plan(longest).agg(F.sum("taken")).first()[0] <= 1.5 * 300_002


def test_mixing_query_equals_the_queue(spark):
    from locusmill.llm.queries import op8_mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken, target = brute_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], mix_order(docs))
    want = Counter({i: n for (i, _, _), n in taken.items()})
    assert Counter({r.doc_id: r.taken for r in op8_mixing(spark, SF).collect() if r.taken}) == want


# ---------------------------------------------------------------- token planes
@pytest.mark.parametrize("bits", [False, True])
def test_shards_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (0, 1, 100, 5000):
        ids = rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32)
        lengths = [n] if n else []
        shard = token_planes.pack_shard(ids, [None] * len(lengths), lengths, block_ids=1024, bits=bits)
        back, names, sizes = token_planes.unpack_shard(shard)
        assert (back == ids).all() and names == [None] * len(lengths) and sizes == lengths
    assert (token_planes.read_block(shard, 2) == ids[2048:3072]).all()


def test_encoder_equals_library():
    import random

    from tokenizers import Tokenizer

    path = tokenizer_path(WORD_BPE)
    whole, own, rng = Tokenizer.from_file(path), token_planes.WordEncoder(path), random.Random(3)
    letters = [*"abcXYZ0129'’.,é É ß ñ İΣµ²½ª \t\n\x0b\x1c\x85 　中文한🙂́_-#", "<|endoftext|>", "'s", "I'LL", " ", " "]
    for _ in range(2000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert own.encode(t.encode()) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_tokens_through_files(make, spark, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    rows = [(7, "Hello World"), (3, None), (None, "last one"), (5, ""), (4, "some, more words " * 3000), (7, "Hello World")]
    for bits in (False, True):
        token_planes.write_tokens(make(*rows), f"{tmp_path}/t{bits}", tokenizer_path(WORD_BPE), shard_ids=50, block_ids=64, bits=bits, partitions=3)
        got = token_planes.read_tokens(spark, f"{tmp_path}/t{bits}", with_ids=True).collect()
        at = 0
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        assert len(got) == len(rows)
        for r, (i, t) in zip(sorted(got, key=lambda r: r.start), order):
            ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) and list(r.ids) == ids
            at += len(ids)
    (tmp_path / "files").mkdir()
    n = token_planes.export_shards(spark, f"{tmp_path}/tTrue", f"{tmp_path}/files")
    assert n == len(list((tmp_path / "files").iterdir())) > 1
    token_planes.write_tokens(make("x").limit(0), f"{tmp_path}/none", tokenizer_path(WORD_BPE))
    assert token_planes.read_tokens(spark, f"{tmp_path}/none").count() == 0


# ---------------------------------------------------------------- segmentations
@pytest.fixture(scope="module")
def lattices():
    return piece_sampling.Lattices(tokenizer_path(PIECE_BPE), theta=0.3)


def all_segmentations(lattices, text):
    unit, out = (" " + text).replace(" ", "▁"), []

    def rec(i, ids, w):
        if i == len(unit):
            out.append((tuple(ids), w))
        for j in range(i + 1, len(unit) + 1):
            if i < len(unit) and unit[i:j] in lattices.weight:
                rec(j, [*ids, lattices.weight[unit[i:j]][0]], w + lattices.weight[unit[i:j]][1])
        if i < len(unit) and unit[i] not in lattices.weight:
            rec(i + 1, ids + [lattices.byte_id[b] for b in unit[i].encode()], w)

    rec(0, [], 0.0)
    z = math.log(sum(math.exp(w) for _, w in out))
    return {ids: math.exp(w - z) for ids, w in out}


@pytest.mark.parametrize("text", ["the", "cat a", "hi\n"])
def test_samples_follow_the_lattice(lattices, text):
    p, n, k = all_segmentations(lattices, text), 20_000, 2
    keys = np.random.default_rng(4).integers(0, 2**63, n).astype(np.uint64)
    tables, samples = piece_sampling.sample_block(lattices, [text] * n, keys, k)
    first, pairs = Counter(), Counter()
    for own in samples:
        ids = [tuple(tables.piece[s.edges].tolist()) for s in own]
        assert len(set(ids)) == len(ids) and own[0].value >= own[-1].value
        assert all(math.exp(s.logp) == pytest.approx(p[i], rel=1e-4) for s, i in zip(own, ids))
        first[ids[0]] += 1
        pairs[tuple(ids)] += 1
    values = np.array([[s.value for s in own] for own in samples])
    scores = np.array([math.exp(s.log_inclusion) for own in samples for s in own])
    del tables, samples, own
    for want, got in (({a: n * q for a, q in p.items()}, first), ({(a, b): n * p[a] * p[b] / (1 - p[a]) for a in p for b in p if a != b}, pairs)):
        cells = [(e, got[c]) for c, e in want.items() if e > 20]
        assert sum((g - e) ** 2 / e for e, g in cells) < len(cells) + 5 * math.sqrt(2 * len(cells)) + 5
    # Perturbed values and inclusion scores against independently perturbed segmentations.
    logs = np.log(np.array(list(p.values())))
    direct = logs + np.random.default_rng(1).gumbel(size=(n, len(logs)))
    best = -np.sort(-direct, axis=1)
    assert np.allclose(values.mean(axis=0), best[:, :k].mean(axis=0), atol=0.05) and np.allclose(values.std(axis=0), best[:, :k].std(axis=0), atol=0.05)
    top = np.argsort(-direct, axis=1)[:, :k]
    included = 1 - np.exp(-np.exp(np.take_along_axis(np.broadcast_to(logs, direct.shape), top, axis=1) - best[:, k : k + 1]))
    assert np.allclose(np.quantile(scores, [0.1, 0.25, 0.5, 0.75]), np.quantile(included, [0.1, 0.25, 0.5, 0.75]), atol=0.03)


def test_one_by_one_tables_equal_joint_tables(lattices, monkeypatch):
    texts = ["Die Straße, the catalogue of things…\n中文 x▁y 🙂", "a" * 200, "plain words"]
    keys = np.arange(3).astype(np.uint64)
    out = []
    for together in (48, 0):
        monkeypatch.setattr(piece_sampling, "TOGETHER", together)
        lattices.clear()
        tables, samples = piece_sampling.sample_block(lattices, texts, keys, 3)
        out.append([[(tables.piece[s.edges].tolist(), round(s.logp, 2)) for s in own] for own in samples])
        assert all(lattices.decode(tables.piece[s.edges])[1:].decode() == t for own, t in zip(samples, texts) for s in own)
        del tables, samples
    lattices.clear()
    assert [[x[1] for x in own[:1]] for own in out[0]] and all(len(a) == len(b) == 3 for a, b in zip(*out))


def test_memory_of_tables(lattices, monkeypatch):
    """Bytes of an edge and units a worker of the query keeps: with 18 and 650,000 an executor's workers passed the memory they have."""
    from locusmill.llm import queries

    lattices.clear()
    lattices.units_of(["some plain words and Straße"])
    assert sum(x.itemsize for x in (lattices.piece, lattices.next, lattices.logq, lattices.upto)) <= 14
    assert len({len(x) for x in (lattices.piece, lattices.next, lattices.logq, lattices.upto)}) == 1
    monkeypatch.setattr(queries, "table", lambda *_: None)
    monkeypatch.setattr(piece_sampling, "sample_segmentations", lambda *_, **options: options)
    assert queries.op6_piece_sampling(None, SF).get("cache_units", piece_sampling.CACHE_UNITS) <= 350_000


def test_rear_sets_are_entered(lattices, monkeypatch):
    monkeypatch.setattr(piece_sampling, "FRONT", 1)
    p, n = all_segmentations(lattices, "cat a"), 8000
    tables, samples = piece_sampling.sample_block(lattices, ["cat a"] * n, np.arange(n).astype(np.uint64), 2)
    pairs = Counter(tuple(tuple(tables.piece[s.edges].tolist()) for s in own) for own in samples)
    del tables, samples
    cells = [(n * p[a] * p[b] / (1 - p[a]), pairs[a, b]) for a in p for b in p if a != b and n * p[a] * p[b] / (1 - p[a]) > 20]
    assert sum((g - e) ** 2 / e for e, g in cells) < len(cells) + 5 * math.sqrt(2 * len(cells)) + 5


def test_segmentation_rows(make):
    rows = [(1, "some text"), (1, "some text"), (None, "x▁y\n  z"), (2, None), (3, ""), (4, "long word " * 20_000)]
    got = piece_sampling.sample_segmentations(make(*rows), tokenizer_path(PIECE_BPE), k=3, with_ids=True).collect()
    same = piece_sampling.sample_segmentations(make(*reversed(rows)), tokenizer_path(PIECE_BPE), k=3, cache_units=1, block_chars=10).collect()
    key = lambda r: (r.doc_id or -1, r["sample"], r.n_pieces, r.ids_crc32)
    assert sorted(map(key, got)) == sorted(map(key, same)) and all(r.decoded for r in got)
    n = Counter(r.doc_id for r in got)
    assert n == {1: 6, None: 3, 2: 1, 3: 1, 4: 3}
    assert piece_sampling.sample_segmentations(make("x").limit(0), tokenizer_path(PIECE_BPE)).count() == 0


def test_query_and_pipeline_hand_over_ids(spark, make):
    import zlib

    import corpus_pipeline as P
    from locusmill.llm.queries import op6_piece_sampling

    rows = op6_piece_sampling(spark, SF).limit(20).collect() + P.segmentations(spark, make("some words", "é x", ""), SF).collect()
    for r in rows:
        assert len(r.ids) == r.n_pieces and zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32


def test_tokens_of_the_table_equal_the_library(spark):
    """The registered query on the whole table against the library on whole texts."""
    from tokenizers import Tokenizer

    from locusmill.llm.queries import op2_token_planes

    tokenizer = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    start, want = 0, []
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    got = op2_token_planes(spark, SF).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want


# ---------------------------------------------------------------- pages
def page(i, body, extra=""):
    return f'<!DOCTYPE html><html><head><title>t{i}</title><script>var x="</p>";</script></head><body><nav><a href="/x">menu</a></nav><div class="cookie-notice">We use cookies</div>{extra}{body}<aside>side {i}</aside><footer>&copy; site</footer></body></html>'


def test_extraction(spark):
    body = "<article><h1>Title &amp; {i}</h1><p>One <b>two</b>\n three<br>four &lt;x&gt;<p>five<div class=ad>buy</div><form>f<input></form><ul><li>a<li>b</ul><section class='user comments'><p>nice</p></section></article>"
    rows = [(i, f"http://h.example/{i}", page(i, body.replace("{i}", str(i)))) for i in range(6)]
    rows += [(10, None, None), (11, "http://one.example/", page(11, "<main><p>alone é</p></main>")), (12, "http://h.example/x", page(12, "<article></article>")), (13, "http://h.example/cut", "<html><body><nav>m</nav><article><p>cut off &am"), (None, "http://h.example/n", page(0, "<article><p>x</p></article>"))]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        want = f"Title & {i}\nOne two three four <x>\nfive\na\nb"
        assert got[i] == (want, len(want))
    assert got[10] == ("", 0) and got[11][0] == "alone é" and got[12][0] == "" and got[13][0] == "cut off &am" and got[None][0] == "x"
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_template_text_goes_without_article_element(spark):
    filler = "one two three four five six seven eight nine ten words"
    rows = [(i, f"http://d.example/{i}", f"<html><body><div class=x><p>Welcome to our site</p><div class=y><p>story {i} {filler}</p><p>end {i}</p></div></div></body></html>") for i in range(8)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"story {i} {filler}\nend {i}" for i in range(8)}


def test_class_needs_start_and_end_on_the_same_pages(spark):
    pages = spark.createDataFrame([("h", f"<html><body><article>{'a' * 50}</article>{'<div>x</div>' * (i % 3)}</body></html>") for i in range(9)], "host string, html string")
    classes = [c for r in html_extract.templates(html_extract.tokens(pages, "host", "html"), 0.5, 4).where("host = 'h'").collect() for c in r.classes]
    whole = next(c for c in classes if c["n_pages"] == c["n_occ"] == 9)
    assert {t["token"] for t in whole["tokens"]} >= {"<>html>body>article", "</>html>body>article"}
    assert html_extract.article_of(classes, 0.6)[0] == ">html>body>article"


def test_notice_inside_article_goes(spark):
    rows = [(i, f"http://n.example/{i}", f"<html><body><article><p>All stories are free to read this week.</p><p>story {i} {'word ' * 40}{i}</p><p>end {i}</p></article></body></html>") for i in range(8)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"story {i} {'word ' * 40}{i}\nend {i}" for i in range(8)}


def test_texts_out_of_order_are_no_template(spark):
    pair = "<p>first of two</p><p>second of two</p>", "<p>second of two</p><p>first of two</p>"
    rows = [(i, f"http://o.example/{i}", f"<html><body><article>{pair[i % 2]}<p>story {i} {'word ' * 40}{i}</p></article></body></html>") for i in range(8)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(sum(line in got[i] for line in ("first of two", "second of two")) >= 1 for i in range(8))


def test_element_without_end_is_not_valid(spark):
    pages = spark.createDataFrame([("h", f"<html><body><section><article>{'a' * 50}{i}</section></body></html>") for i in range(9)], "host string, html string")
    classes = [c for r in html_extract.templates(html_extract.tokens(pages, "host", "html"), 0.5, 4).where("host = 'h'").collect() for c in r.classes]
    assert not any(t["token"] == "</>html>body>section>article" for c in classes for t in c["tokens"])
    assert html_extract.article_of(classes, 0.6)[0] == ">html>body>section"


def test_deep_containers_end_with_their_own_tags():
    page = f"<article><div>{'<div>' * 300}deep<nav>menu</nav>{'</div>' * 300}<p>after</p></div></article>"
    got = {text: (path, noise) for kind, path, noise, text, _ in html_extract.nodes(page) if kind == "t"}
    assert got["after"] == (">article>div", False) and got["menu"][1] and not got["deep"][1]
    starts, ends = ([path for kind, path, *_ in html_extract.nodes(page) if kind == k] for k in ("<", "</"))
    assert starts == ends[::-1]


def test_articles_below_any_depth(spark):
    filler = "one two three four five six seven eight nine ten words"
    deep = lambda k, inner: "<div>" * k + inner + "</div>" * k
    body = "<nav>menu</nav><div class=box><p>Welcome to our site</p>{}</div><div class=other><p>See also what others read</p></div>"
    story = "<section><p>story {i} {f}</p><ul><li>point {i}</ul><section><p>end {i}</p></section></section>"
    for k in (5, 250, 1200):
        rows = [(i, f"http://d{k}.example/{i}", "<html><body>" + body.format(deep(k, "<nav>inner menu</nav>" + story.format(i=i, f=filler) + "<form>f</form>")) + "</body></html>") for i in range(8)]
        got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == {i: f"story {i} {filler}\npoint {i}\nend {i}" for i in range(8)}, k
    assert len({p for kind, p, *_ in html_extract.nodes("<div>" * 5000) if kind == "<"}) == 5000 and max(len(p) for _, p, *_ in html_extract.nodes("<div>" * 5000)) < 1100


def test_the_template_decides_what_is_left(spark):
    """Without a template (too few pages for any text to be a token of it) the notice inside the article stays; with it, it goes."""
    filler = " ".join(f"word{k}" for k in range(40))
    rows = [(i, f"http://n.example/{i}", f"<html><body><article><p>All stories are free to read this week.</p><p>story {i} {filler} {i}</p></article></body></html>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    on = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    off = {r.page_id: r.text for r in html_extract.extract(pages, least_pages=100).collect()}
    assert on == {i: f"story {i} {filler} {i}" for i in range(8)} and all(off[i] == f"All stories are free to read this week.\n{on[i]}" for i in on)


def test_adverts_and_notices_in_paragraphs_go(spark):
    """Paragraphs and headings whose class, id or role tells what they are; what follows them stays."""
    body = "<article><h1>T {i}</h1><p class='advert'>Buy <b>now</b><br>cheap<p>one {i}</p><h3 id=related-posts>More</h3><p>two {i}</p><p role=alert>Mind<hr>three {i}<h2 class='share'>Tell<div>four {i}</div></article>"
    rows = [(i, f"http://p.example/{i}", f"<html><body>{body.replace('{i}', str(i))}</body></html>") for i in range(3)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"T {i}\none {i}\ntwo {i}\nthree {i}\nfour {i}" for i in range(3)}


def test_pages_clashing_columns_ties_and_long_pages(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, "http://a.example/", "<article><p>same</p></article>")] * 3 + [(2, "http://a.example/", long), (None, None, None), (2, None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit("h")).withColumn("id", F.lit(2)).withColumn("classes", F.lit(3))
    got = html_extract.extract(pages).collect()
    assert len(got) == 6 and [r.text for r in got if r.page_id == 1] == ["same"] * 3 and sorted(r.n_chars for r in got if r.page_id == 2) == [1, 999_999]


def test_pages_query(spark):
    import html

    from locusmill.llm.queries import op10_html_extract

    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op10_html_extract(spark, SF).collect():
        inside = source[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b)


# ---------------------------------------------------------------- pipeline
def pipeline_parts(spark, docs):
    """Each stage on all that its predecessor kept, against brute force, row for row."""
    import corpus_pipeline as P

    from test_dedup import jaccard, shingle_set
    from test_text_filters import brute_counts

    columns = docs.columns
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    kept = P.materialise(P.quality(spark, docs, SF))
    assert kept.columns == columns and not any(brute_counts(r.text)[-1] for r in kept.collect())
    exact = P.materialise(P.exact(spark, kept, SF))
    least = {}
    for r in kept.collect():
        k = norm(r.text)
        least[k] = r.doc_id if k not in least or least[k] is None or (r.doc_id is not None and r.doc_id < least[k]) else least[k]
    assert exact.columns == columns and sorted((norm(r.text), r.doc_id or -1) for r in exact.collect()) == sorted((k, -1 if i is None else i) for k, i in least.items())
    near = P.materialise(P.near(spark, exact, SF))
    before, after = [r for r in exact.collect()], {(r.doc_id, r.text) for r in near.collect()}
    sets = {(r.doc_id, r.text): shingle_set(r.text) for r in before}
    left = [x for x in sets if x in after]
    assert near.columns == columns and near.count() == len(after) <= len(before)
    missed = sum(jaccard(sets[a], sets[b]) >= 0.82 for i, a in enumerate(left) for b in left[i + 1 :] if 10 * min(len(sets[a]), len(sets[b])) >= 8 * max(len(sets[a]), len(sets[b])))
    assert missed <= 0.1 * (len(before) - len(left)) + 0
    for x in sets.keys() - after:
        assert max(jaccard(sets[x], sets[y]) for y in sets if y != x) >= 0.7
    mixed = P.materialise(P.mixture(spark, near, SF))
    taken, _ = brute_mix([(r.doc_id, r.text, r.source) for r in near.collect()], mix_order(near))
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id, r.text, r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    assert mixed.columns == columns and got == taken
    last = P.segmentations(spark, mixed, SF).collect()
    assert all(r.decoded for r in last) and 2 * mixed.count() >= len(last) >= mixed.count()
    return kept, exact, near, mixed


def test_pipeline_stages_equal_their_parts(spark):
    import corpus_pipeline as P

    pipeline_parts(spark, P.table(spark, SF, "documents").where("n_chars < 1500"))
    assert [n for n, _ in P.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "segmentation"]


def test_pipeline_stages_on_null_empty_and_repeated_rows(spark, make):
    good = "The first of many plain words that stand here in a row, and none of them is said again."
    other = "Here is another text of the kind that one finds in a book about trees, rivers and birds."
    rows = [(1, good), (1, good), (1, other), (None, good), (None, None), (2, ""), (3, None), (None, other + " Yes."), (4, " " + good.replace(" ", "  "), None, None), (5, "w " * 50)]
    kept, exact, near, mixed = pipeline_parts(spark, make(*rows))
    assert sorted((r.doc_id or -1) for r in exact.collect()) == [-1, 1, 1, 4] or exact.count() >= 3
    assert {r.text for r in near.collect()} <= {r.text for r in kept.collect()} and mixed.count() >= 1
    for stage in (0, 1, 2, 3):
        import corpus_pipeline as P

        assert P.STAGES[stage][1](spark, kept.limit(0), SF).count() == 0
