import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import line_crf, pii, quality_rules, toxicity
from locusmill.llm.common import crc_bucket

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- quality rules
def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


QUALITY = [None, "", " ", "a b", "x\n\nx\n \nx", "a b c d e a b c d e", "a b c d e f a b c d e f g", "one two three four five six seven eight nine ten", "# * $ & | <> é ÀÉ 1 ２", "w " * 60_000, "line one\nline one\n" * 4, "a a a a a a"]


def test_counts_equal_brute_force(make):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(make(*QUALITY)).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(QUALITY)}


def test_counts_on_the_table(spark):
    from locusmill.llm.queries import op7_quality_rules

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 6000").collect()}
    rows = {r.doc_id: r for r in op7_quality_rules(spark, SF).collect()}
    for i, t in texts.items():
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(t)
        assert not (r.base_failed and r.kept)


def test_js_distance(spark):
    row = spark.range(1).select(quality_rules.js_distance(F.array(F.lit(1).cast("long"), F.lit(0).cast("long")), F.array(F.lit(0.0), F.lit(1.0))).alias("far"), quality_rules.js_distance(F.array(F.lit(2).cast("long"), F.lit(2).cast("long")), F.array(F.lit(0.5), F.lit(0.5))).alias("same"), quality_rules.js_distance(F.array(F.lit(0).cast("long")), F.array(F.lit(1.0))).alias("none")).first()
    assert row.far == pytest.approx(1) and row.same == pytest.approx(0) and row.none is None


def test_junk_goes_clean_stays(spark):
    rows = quality_rules.judge(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    kept = {r.quality: (r.n, r.k) for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1][1] / kept[1][0] > 0.97 and kept[0][1] / kept[0][0] < 0.2


def test_keep_good_keeps_columns_and_nulls(make):
    docs = make((1, QUALITY[7], None, None), (None, QUALITY[7]), (2, None)).withColumn("n_words", F.lit("mine")).withColumn("__text", F.lit(1))
    out = quality_rules.keep_good(docs)
    assert out.columns == docs.columns and sorted((r.doc_id or -1) for r in out.collect()) == [-1, 1] and out.first().n_words == "mine"
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def test_language_without_a_list_has_its_own_reference(make):
    rng = random.Random(3)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(150))
    hebrew, latin = "אבגדהוזחטיכלמנסעפצקרשת", "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, text(latin), "en", "a") for i in range(200)] + [(i, "של " * 3 + text(hebrew), "he", "a") for i in range(200, 230)]
    rows += [(300, text("#*$%&"), "he", "a"), (301, text(hebrew), "xx", "a"), (302, text(latin), None, "a")]
    got = {r.doc_id: r for r in quality_rules.judge(make(*rows), max_words_distance=1.0).collect()}
    assert len(got) == 233 and all(got[i].kept for i in range(200, 230)) and not got[300].kept and got[302].kept
    # A language of one document has no reference, so nothing is said against its text.
    assert got[200].words_distance is not None and got[301].words_distance is None and got[301].chars_distance is None and got[301].kept


def test_clean_texts_of_a_small_language_stay(make):
    """Nineteen clean texts of a language without a list in a Latin corpus, and junk in that language, which the base rules judge."""
    rng = random.Random(5)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(150))
    rows = [(i, text("abcdefghijklmnop"), "en", "a") for i in range(60)] + [(100 + i, text("אבגדהוזחטיכל"), "he", "a") for i in range(19)] + [(200, "אב " * 300, "he", "a")]
    docs = make(*rows)
    kept = {r.doc_id for r in quality_rules.keep_good(docs, max_words_distance=1.0).collect()}
    assert kept >= {100 + i for i in range(19)} and 200 not in kept


def test_judge_keeps_columns_of_any_name(make):
    names = ["c_lower", "__text", "__words", "__row", "__t", "documents", "__own_chars"]
    docs = make((1, QUALITY[7]), (2, None), (None, "")).withColumns({c: F.lit("mine") for c in names}).withColumn("n_words", F.lit("gives way"))
    got = quality_rules.judge(docs)
    assert got.columns == [c for c in docs.columns if c != "n_words"] + list(quality_rules.VERDICTS)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == 3 and all(r[c] == "mine" for r in rows.values() for c in names) and rows[1].n_words == 10 and rows[1].kept and not rows[2].kept
    assert quality_rules.judge(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- personal data
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for k, (name, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if name == "ip" else True, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[name]
            if ok:
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


def test_base_spans_equal_brute_force():
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice("12345 .-+@aé()b%5") for _ in range(rng.randint(0, 45)))
        assert [s[:3] for s in pii.base_spans(t)] == [s[:3] for s in brute_spans(t)], t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "@" * 300_000, "+1" + "(" * 300_000):
        pii.base_spans(t)


def test_parts_of_any_number_of_zeros():
    """An address whose part has more zeros than Python turns into a number, and one with a digit after them."""
    for t, n in (("0" * 5000 + ".1.1.1", 1), ("1.1.1." + "0" * 6000 + "255", 1), ("1.1.1." + "0" * 6000 + "256", 0)):
        assert len([s for s in pii.base_spans(t) if s[1] == 1]) == n


def test_pii_query_equals_brute_force(spark):
    from locusmill.llm.queries import op3_pii

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    terms = brute_terms(texts)
    for r in op3_pii(spark, SF).collect():
        spans = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{n}:{a}:{b}" for a, _, b, n in spans).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[3] == k for s in spans) for k in PATTERNS)
        assert r.spans == ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(spans + terms.get(r.doc_id, [])))


def brute_terms(texts, support=3, least=0.8):
    """Revealing terms by definition: all entities against all terms of all documents."""
    import math

    held, words = {}, {}
    for i, t in texts.items():
        spans = brute_spans(t or "")
        words[i] = [m for m in re.finditer(r"\w{3,}", t or "") if not any(a < m.end() and m.start() < b for a, _, b, _ in spans)]
        own = set()
        for a, _, b, kind in spans:
            value = t[a:b]
            if kind == "email":
                local, domain = value.lower().split("@")
                own |= {f"email:{value.lower()}", f"domain:{domain}"} | {f"name:{n}" for n in re.findall("[a-z]{3,}", local)}
            elif kind == "ip":
                own |= {f"ip:{value}", "network:" + value.rsplit(".", 1)[0]}
            elif kind == "card":
                digits = re.sub("[^0-9]", "", value)
                own |= {f"card:{digits}", f"issuer:{digits[:6]}"}
            else:
                own.add(f"phone:{re.sub('[^0-9]', '', value)}")
        held[i] = own
    every = Counter(w for t in texts.values() for w in {m.lower() for m in re.findall(r"\w{3,}", t or "")})
    n_c = Counter(e for own in held.values() for e in own)
    n_ct = Counter((e, w) for i, own in held.items() for e in own for w in {m[0].lower() for m in words[i]})
    n = len(texts)
    good = {p for p, k in n_ct.items() if k >= support and n_c[p[0]] < n and math.log2(k * n / (n_c[p[0]] * every[p[1]])) / math.log2(n / n_c[p[0]]) >= least - 1e-12}
    return {i: [(m.start(), 4, m.end(), "term") for m in words[i] if any((e, m[0].lower()) in good for e in own)] for i, own in held.items()}


def test_what_entities_share_is_revealed_too(make):
    rows = [f"the Zorblax office mail is p{i}@corp.example.com today number {i}" for i in range(6)] + [f"the office mail is closed today number {i}" for i in range(60)]
    rows += [f"the Quuxley gate of 10.20.30.{i} stays shut number {i}" for i in range(4)]
    got = {r.doc_id: r.spans for r in pii.find_pii(make(*rows)).collect()}
    terms = {i: {rows[i][s["start"] : s["end"]] for s in spans if s["kind"] == "term"} for i, spans in got.items()}
    assert all("Zorblax" in terms[i] for i in range(6)) and all("Quuxley" in terms[66 + i] for i in range(4)) and not any(terms[i] for i in range(6, 66))


def test_many_spans_in_one_text_take_linear_time(make):
    import time

    text = " ".join(f"name{i}@host{i}.example.com word{i}" for i in range(10_000))
    began = time.process_time()
    spans = pii.base_spans(text)
    assert len(spans) == 10_000 and sum(1 for _ in pii.outside_terms(text, [(s[0], s[2]) for s in spans])) == 10_000
    assert time.process_time() - began < 2
    got = pii.find_pii(make((1, text), (2, None), (4, "other words"))).collect()
    assert len(got) == 3 and {len(r.base) for r in got} == {0, 10_000}


def test_sanitise_keeps_clashing_columns_and_repeated_ids(make):
    rows = [(1, "mail ann@corp.example.com now"), (1, "no mail now"), (None, "mail ann@corp.example.com now"), (1, "mail ann@corp.example.com now")]
    docs = make(*rows).withColumn("id", F.lit("x")).withColumn("__id", F.lit(1)).withColumn("__spans", F.lit(2)).withColumn("spans", F.lit(3)).withColumn("row", F.lit(4))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    assert sorted(r.text for r in out.collect()) == ["mail [EMAIL] now"] * 3 + ["no mail now"]


def test_revealing_terms(make):
    rows = [f"the Zorblax office mail is ann@corp.example.com today number {i}" for i in range(6)] + [f"the office mail is closed today number {i}" for i in range(60)] + [None, ""]
    got = {r.doc_id: r.spans for r in pii.find_pii(make(*rows)).collect()}
    terms = {i: [rows[i][s["start"] : s["end"]] for s in spans if s["kind"] == "term"] for i, spans in got.items() if spans}
    assert terms and all(v == ["Zorblax"] for v in terms.values()) and set(terms) == set(range(6))
    clean = {r.doc_id: r.text for r in pii.sanitise(make(*rows)).collect()}
    assert "Zorblax" not in clean[0] and "[EMAIL]" in clean[0] and clean[10] == rows[10] and clean[66] is None
    assert pii.find_pii(make("x").limit(0)).count() == 0


def test_revealing_terms_far_from_the_entity(make):
    far = "plain filler words stand here between both of them " * 20
    rows = [f"Zorblax mail {far} mail ann@corp.example.com Zorblax {i}" if i % 2 else f"Zorblax mail {far} mail ann@corp.example.com {i}" for i in range(6)] + [f"{far} mail {i}" for i in range(60)] + ["Quuxley mail"] * 2
    got = {r.doc_id: r.spans for r in pii.find_pii(make(*rows)).collect()}
    terms = {i: [s["start"] for s in spans if s["kind"] == "term"] for i, spans in got.items() if len(spans) > 1}
    assert terms == {i: [m.start() for m in re.finditer("Zorblax", rows[i])] for i in range(6)}
    assert "Zorblax" not in "".join(r.text for r in pii.sanitise(make(*rows)).collect())


def test_document_frequency_equals_brute_force(make, spark):
    rng = random.Random(1)
    rows = [" ".join(rng.choice(("alpha", "beta", "gamma", "delta", "épsilon")) for _ in range(4)) for _ in range(50)]
    terms = spark.createDataFrame([("alpha",), ("épsilon",), ("missing",)], "term string")
    got = {r.term: r.n_t for r in pii.document_frequency(make(*rows), terms).collect()}
    assert got == {t: sum(t in r.split() for r in rows) for t in ("alpha", "épsilon")}


# ---------------------------------------------------------------- toxicity
def brute_segments(hits, drift):
    n = hits[-1][0] + 1
    s = [-drift] * n
    for p, v in hits:
        s[p] = v

    def rec(a, b):
        best = (0, 0, 0)
        for i in range(a, b):
            t = 0
            for j in range(i, b):
                t += s[j]
                if t > best[0] + 1e-9:
                    best = (t, i, j + 1)
        return rec(a, best[1]) + [(best[1], best[2] - 1, round(best[0], 6))] + rec(best[2], b) if best[0] > 0 else []

    return rec(0, n)


def test_maximal_segments_equal_definition():
    rng = random.Random(2)
    for _ in range(300):
        hits = [(p, rng.choice([1.13, 2.31, 0.57, 3.01])) for p in sorted(rng.sample(range(40), rng.randint(1, 9)))]
        got = [(hits[a][0], hits[b][0], round(s, 6)) for a, b, s in toxicity.maximal_segments(hits, 0.37)]
        assert got == brute_segments(hits, 0.37)


def test_segments_are_linear_in_hits():
    toxicity.maximal_segments([(i, 1.0 + (i * 7919 % 13) / 10) for i in range(0, 400_000, 2)], 0.5)


def test_karlin_lambda_solves_its_equation():
    import math

    scores, drift = {2.0: 0.01, 4.0: 0.001}, 0.1
    x = toxicity.karlin_lambda(scores, drift)
    assert sum(p * math.exp(x * s) for s, p in scores.items()) + (1 - 0.011) * math.exp(-x * drift) == pytest.approx(1, abs=1e-6)


def test_isotonic_is_monotone():
    got = toxicity.isotonic([(0, 10), (5, 5), (1, 9), (9, 1)], 0.3)
    assert got == sorted(got) and len(got) == 4


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    for v in np.unique(score):
        rank[score == v] = np.mean(np.flatnonzero(np.sort(score) == v)) + 1
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (len(label) - n1) if len(order) else 0


def held_out(spark, name, label, mod, rest):
    from locusmill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % mod == rest for i in rows["doc_id"]]).all()
    test = rows[rows["held_out"]]
    return test["score"].to_numpy(), test[label].to_numpy(), test["predicted"].to_numpy()


def test_toxicity_held_out_accuracy(spark):
    score, label, predicted = held_out(spark, "op1_toxicity", "toxic", 3, 1)
    assert auc(score, label) > 0.93 and label[predicted == 1].mean() > 0.9 and predicted[label == 1].mean() > 0.8


def test_toxic_passages_and_edges(make, spark):
    rows = [(i, f"plain words here number {i} and some idiot moron words" if i % 4 == 0 else f"plain words here number {i} and some more words") for i in range(200)]
    docs = make(*rows, (500, None), (501, ""))
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, F.lit(True)).collect()}
    assert got[196].score > 0.7 > got[197].score and len(got) == 202 and got[500].score == got[501].score
    p = got[196].passages[0]
    assert "idiot moron" in rows[196][1][p["start"] : p["end"]]
    none = toxicity.score_toxicity(docs, labels.limit(0), F.lit(True))
    assert {round(r.score, 3) for r in none.collect()} == {0.499}
    assert toxicity.score_toxicity(docs.limit(0), labels, F.lit(True)).count() == 0


# ---------------------------------------------------------------- line field
def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    starts, score, trans = np.array([0, 1, 5, 8]), rng.normal(size=8), rng.normal(size=(2, 2))
    good, logz, expected = line_crf.marginals(score, trans, starts, pairs=True, cells=6)
    total = np.zeros((2, 2))
    for t, (a, b) in enumerate(zip(starts, starts[1:])):
        w = {s: np.exp(sum(score[a + i] * s[i] for i in range(b - a)) + sum(trans[s[i], s[i + 1]] for i in range(b - a - 1))) for s in itertools.product((0, 1), repeat=int(b - a))}
        z = sum(w.values())
        assert logz[t] == pytest.approx(np.log(z))
        for i in range(b - a):
            assert good[a + i] == pytest.approx(sum(v for s, v in w.items() if s[i]) / z)
        for s, v in w.items():
            for i in range(b - a - 1):
                total[s[i], s[i + 1]] += v / z
    assert np.allclose(total, expected)


def test_field_gradient():
    rng = np.random.default_rng(1)
    x, y, starts = rng.normal(size=(12, 3)), rng.integers(0, 2, 12), np.array([0, 4, 7, 12])
    field = line_crf.fit_labels(x, y, starts, 0.1, 200)
    again = line_crf.fit_labels(x, y, starts, 0.1, 400)
    assert np.allclose(field.weights, again.weights, atol=1e-2)


def test_quality_held_out_accuracy(spark):
    score, label, predicted = held_out(spark, "op5_line_crf", "quality", 5, 0)
    assert auc(score, label) > 0.97 and (predicted == label).mean() > 0.97


def test_quality_edges(make, spark):
    docs = make((1, None), (2, ""), (3, "\n\n"), (4, "x"), (None, "y z"), (6, "a\n" * 20_000))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = line_crf.score_quality(docs, labels, crc_bucket("doc_id", 5) != 99).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert line_crf.score_quality(docs.limit(0), labels, F.lit(True)).count() == 0


def test_one_text_of_many_lines_beside_short_ones_is_bounded():
    import tracemalloc

    field = line_crf.Field(np.linspace(-1, 1, 61), np.array([[0.2, 0.0], [0.0, 0.3]]))
    texts = [b"one line here\nand another"] * 500 + [b"a line of words\n" * 200_000]
    tracemalloc.start()
    good, length, starts = field.good(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    alone, *_ = field.good(texts[-1:])
    assert peak < 1 << 30 and np.allclose(good[starts[-2] :], alone) and np.allclose(good[:2], field.good(texts[:1])[0])


def test_cells_do_not_change_marginals():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 40, 60)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    score, trans = rng.normal(size=int(starts[-1])), rng.normal(size=(2, 2))
    a, b = (line_crf.marginals(score, trans, starts, pairs=True, cells=c) for c in (1, 1 << 18))
    assert all(np.allclose(x, y) for x, y in zip(a, b))


def test_quality_ties_repeats_and_clashing_columns(make, spark):
    rows = [(i, "Plain words of a good line.\nAnd one more of them.") if i % 2 else (i, "### $$$ %%%\n### $$$ %%%") for i in range(60)]
    docs = make(*rows, (1, "### $$$ %%%\n### $$$ %%%"), (1, rows[1][1])).withColumn("id", F.lit("x")).withColumn("label", F.lit(0)).withColumn("quality", F.lit(9))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = line_crf.score_quality(docs, labels, F.lit(True)).collect()
    good, bad = {r.score for r in got if r.doc_id != 1 and r.doc_id % 2}, {r.score for r in got if r.doc_id % 2 == 0}
    assert len(got) == 62 and len(good) == len(bad) == 1 and min(good) > max(bad)
    assert {r.score for r in got if r.doc_id == 1} == good | bad


def test_quality_sample_leaves_out_whole_rows_only(make, spark):
    long = "### $$$ %%%\n" * 3000
    rows = [(i, "Plain words of a good line." if i % 2 else "### $$$ %%%") for i in range(40)] + [(100, long)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(100, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in line_crf.score_quality(make(*rows), labels, F.lit(True), max_bytes=2000).collect()}
    assert got[1] > got[100] and got[1] > got[2]


def test_quality_sample_has_both_labels_and_long_texts(make, spark):
    """A text above the byte bound is drawn as any other, and each label has a row even where the bound is one byte."""
    long = "### $$$ %%%\n" * 3000
    rows = [(i, "Plain words of a good line.\nAnd one more.") for i in range(20)] + [(100 + i, long) for i in range(4)]
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(4)], "doc_id long, quality int")
    for bound in (1, 2000):
        got = {r.doc_id: r.score for r in line_crf.score_quality(make(*rows), labels, F.lit(True), max_bytes=bound).collect()}
        assert len(got) == 24 and got[1] > got[100]


def test_toxic_words_in_clean_text_do_not_end_the_query(make, spark):
    rows = [(i, "idiot moron" if i % 2 else "fine words") for i in range(400)] + [(1000 + i, "idiot") for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1000 + i, 0) for i in range(20)], "doc_id long, toxic int")
    clean = [r for r in rows if not (r[0] < 400 and r[0] % 2)]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(make(*rows), labels, F.lit(True)).collect()}
    assert len(got) == 420 and got[1] > got[0] and all(0 <= x <= 1 for x in got.values())
    # Clean documents made of toxic words only: no word is left to drift at.
    own = spark.createDataFrame([(i, int(i < 400 and i % 2)) for i, _ in rows], "doc_id long, toxic int")
    every = toxicity.score_toxicity(make(*[(i, "idiot moron") for i, _ in rows], (5000, None)), own, F.lit(True), least_z=-99.0, least_odds=-99.0).collect()
    assert len(every) == 421 and len(clean) == 220


def test_toxicity_long_texts_ties_repeats_and_clashing_columns(make, spark):
    rows = [(i, f"plain words here number {i} and some idiot moron words" if i % 4 == 0 else f"plain words here number {i} and some more words") for i in range(200)]
    long = "plain words " * 200_000 + "idiot moron idiot moron " + "plain words " * 200_000
    docs = make(*rows, (0, rows[1][1]), (None, rows[0][1]), (900, long)).withColumn("id", F.lit("x")).withColumn("hits", F.lit(1)).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(150)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels, F.lit(True)).collect()
    by = lambda i: sorted(round(r.score, 9) for r in got if r.doc_id == i)
    assert len(got) == 203 and by(None) == by(4) and sorted(by(4) + by(1)) == by(0)
    assert [r.n_words for r in got if r.doc_id == 900] == [800_004]


@pytest.mark.parametrize("name, mod, rest", [("op1_toxicity", 3, 1), ("op5_line_crf", 5, 0)])
def test_scores_of_the_registered_query_follow_their_parts(spark, name, mod, rest):
    """The query's rows against the method applied text by text, in plain Python, with the model that the labels give."""
    from locusmill.llm import common
    from locusmill.llm.queries import QUERIES

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES[name](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    keep = ~(crc_bucket("doc_id", mod) == rest)
    if name == "op1_toxicity":
        train = common.training_rows(docs, labels, "toxic", keep, 200_000)
        model = toxicity.fit(train.select("doc_id", "text", "label"), "text", 0.01, 3.0, 1.5, 5, 0.1)
        for r in rows:
            words = toxicity.WORDS.findall(texts[r.doc_id].lower())
            hits = [(i, s) for i, s in enumerate(map(model.score, words)) if s]
            best = brute_segments(hits, 0.1) if hits and len(words) < 300 else None
            if best is not None:
                assert r.evidence > 0 or not [s for *_, s in best if s > 12], r.doc_id
            if not hits:
                assert r.evidence == 0 and r.n_passages == 0
        order = sorted(rows, key=lambda r: r.evidence)
        assert all(a.score <= b.score + 1e-9 for a, b in zip(order, order[1:]))
    else:
        assert all(r.n_lines == texts[r.doc_id].count("\n") + 1 for r in rows)
    assert all(r.predicted == int(r.score >= (0.7 if mod == 3 else 0.3)) for r in rows)
