"""Personal data: base patterns, and terms that reveal a protected entity.

Base spans (e-mail, IP address, payment card, phone) are found in whole texts, leftmost and
non-overlapping per kind. Each distinct value found is a protected entity of the corpus, and so is
what values have in common that points to a person or a place: the domain of an e-mail address, the
names in its local part, the network of an IP address, the issuer of a card. A term of a document that holds an entity, wherever it stands there outside base spans, reveals the entity
as far as knowing the term tells about it: with document frequencies over the whole corpus, PMI(c; t) = log2(n(c,t) N / (n(c) n(t))) is set against the
entity's own information content IC(c) = log2(N / n(c)). Where PMI / IC reaches `generalise_at`
the term is to be replaced by its class, where it reaches `remove_at` it is to be removed, at every
place in all documents that hold the entity. Pairs seen together in fewer than `support` documents
tell nothing and are left alone, and so is any document without an entity.

Only entities in `support` documents can have such a pair, and document frequencies are needed of
the candidate terms only; bit tables of fixed size (FILTER_BITS) with hashes of these entities,
terms and pairs go to all tasks, and what passes one by chance falls out in a join on the values
themselves. Counting pre-aggregates by task. Giving documents their terms is a
join on (entity, term), in which pairs that hold more than 1/HOT_PAIRS of all occurrences, so at
most HOT_PAIRS of them, go by broadcast.

Edge cases: a null text is empty and has no span; a null id is kept as a row of its own, as are
repeated ids; an entity in all documents has IC 0 and nothing reveals it; an empty table gives an
empty result; no pattern retries or looks back over a run of characters, so very long texts take
linear time in finding spans; counting takes a document's recurring entities times its distinct
terms, in bounded memory. Further columns are not looked at, whatever their names; `sanitise` keeps them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, materialise, same, text_of

KINDS = ("email", "ip", "card", "phone", "term")
FILTER_BITS = 1 << 23
HOT_PAIRS = 10_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits starts, so no start inside a run is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_TERM = re.compile(r"\w{3,}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind as its place in KINDS, end, entity) of every base span, in order."""
    out = [(a, 0, b, f"email:{text[a:b].lower()}") for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]  # any number of zeros, which int() takes only so many of
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end(), f"ip:{m[0]}"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end(), f"card:{digits}"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = "".join(_DIGITS.findall(m[0]))
            if 9 <= len(digits) <= 15:
                out.append((m.start(), 3, m.end(), f"phone:{digits}"))
    return sorted(out)


_NAME = re.compile(r"[a-z]{3,}")


def entities_of(value: str) -> list[str]:
    """The entities that a base span's value stands for: itself, and what it shares with others of its owner or place."""
    kind, _, rest = value.partition(":")
    if kind == "email":
        local, _, domain = rest.partition("@")
        return [value, f"domain:{domain}", *(f"name:{n}" for n in _NAME.findall(local))]
    if kind == "ip":
        return [value, f"network:{rest.rpartition('.')[0]}"]
    if kind == "card":
        return [value, f"issuer:{rest[:6]}"]
    return [value]


def outside_terms(text: str, spans: list[tuple[int, int]]) -> Iterator[re.Match]:
    """The words of a text that touch no span; spans in order of their starts."""
    k, until = 0, 0
    for m in _TERM.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            until = max(until, spans[k][1])
            k += 1
        if until <= m.start():
            yield m


_PLACES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string()), ("action", pa.string())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: uid, the id, base spans, distinct entities, and the text where there are any (written to the shared folder)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            spans = [base_spans(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array(range(uid, uid + len(spans)), pa.int64()),
                "id": batch.column(0),
                "h1": batch.column(2),
                "h2": batch.column(3),
                "base": pa.array([[{"start": a, "rank": k, "end": b, "kind": KINDS[k], "action": "remove"} for a, k, b, _ in s] for s in spans], _SPANS),
                "entities": pa.array([sorted({e for *_, value in s for e in entities_of(value)}) for s in spans], pa.list_(pa.string())),
                "text": pc.if_else(pa.array([bool(s) for s in spans], pa.bool_()), batch.column(1), pa.scalar(None, batch.column(1).type)),
            })
            uid += len(spans)

    schema = "uid long, id long, h1 long, h2 long, base array<struct<start:long,rank:int,end:long,kind:string,action:string>>, entities array<string>, text string"
    text = text_of(text_col)
    h1, h2 = content_key(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))
    return materialise(rows.mapInArrow(run, schema))


def _bit_table(keys: DataFrame, *columns: str) -> np.ndarray:
    """FILTER_BITS bits, those at the XXH64 hashes of `columns` set."""
    names = ", ".join(columns)
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    words = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({names}), {FILTER_BITS}) % 64 as int))").alias("b"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.groupBy("w").agg(F.bit_or("b").alias("b")).toLocalIterator():  # at most FILTER_BITS / 64 rows
        table[row["w"]] = row["b"]
    return table.view(np.uint64)


def _in_table(bits: np.ndarray, hashes: Iterator[int], n: int) -> list[int]:
    """Which of `n` hashes have their bit set."""
    at = np.fromiter(hashes, np.uint64, n) & np.uint64(FILTER_BITS - 1)
    return np.flatnonzero((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).tolist()


def _holding(rows: DataFrame) -> DataFrame:
    """(uid, text, starts, ends, entities) of the documents that hold an entity."""
    return rows.where(F.size("entities") > 0).select("uid", "text", F.col("base.start").alias("starts"), F.col("base.end").alias("ends"), "entities")


def pair_counts(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """(entity, term, n_ct): in how many documents each entity of `entities` stands together with each term."""
    shared = rows.sparkSession.sparkContext.broadcast(_bit_table(entities, "entity"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        n: Counter[tuple[str, str]] = Counter()

        def out() -> pa.RecordBatch:
            keys = list(n)
            columns = {"entity": pa.array([k[0] for k in keys], pa.string()), "term": pa.array([k[1] for k in keys], pa.string()), "n": pa.array([n[k] for k in keys], pa.int64())}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for text, starts, ends, held in zip(batch.column(1), batch.column(2), batch.column(3), batch.column(4).to_pylist()):
                held = [held[i] for i in _in_table(shared.value, (xxh64_intdigest(e.encode("utf-8", "surrogatepass"), 42) for e in held), len(held))]
                if not held:
                    continue
                terms = {m[0].lower() for m in outside_terms(text.as_py(), list(zip(starts.as_py(), ends.as_py())))}
                for entity in held:
                    n.update((entity, t) for t in terms)
                    if len(n) > 200_000:
                        yield out()
                        n.clear()
        yield out()

    counts = _holding(rows).mapInArrow(count, "entity string, term string, n long")
    return counts.groupBy("entity", "term").agg(F.sum("n").alias("n_ct")).join(entities.select("entity"), "entity", "left_semi")


def places(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, entity, term, at): where the terms of `pairs` stand in the documents that hold their entity; some other pairs pass too."""
    context = rows.sparkSession.sparkContext
    own, both = context.broadcast(_bit_table(pairs, "entity")), context.broadcast(_bit_table(pairs, "entity", "term"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            uids, entities, terms, at = [], [], [], []
            for uid, text, starts, ends, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3), batch.column(4).to_pylist()):
                seeds = [xxh64_intdigest(e.encode("utf-8", "surrogatepass"), 42) for e in held]
                some = _in_table(own.value, iter(seeds), len(seeds))
                if not some:
                    continue
                found: dict[str, list[dict[str, int]]] = {}
                for m in outside_terms(text.as_py(), list(zip(starts.as_py(), ends.as_py()))):
                    found.setdefault(m[0].lower(), []).append({"start": m.start(), "end": m.end()})
                names = list(found)
                for i in some:
                    for j in _in_table(both.value, (xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seeds[i]) for t in names), len(names)):
                        uids.append(uid)
                        entities.append(held[i])
                        terms.append(names[j])
                        at.append(found[names[j]])
            yield pa.RecordBatch.from_pydict({"uid": pa.array(uids, pa.int64()), "entity": pa.array(entities, pa.string()), "term": pa.array(terms, pa.string()), "at": pa.array(at, _PLACES)})

    return _holding(rows).mapInArrow(find, "uid long, entity string, term string, at array<struct<start:long,end:long>>")


def document_frequency(docs: DataFrame, candidates: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n_t): in how many documents of `docs` each term of `candidates` stands."""
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(candidates, "term"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        n = Counter()

        def passing() -> pa.RecordBatch:
            terms = list(n)
            ok = _in_table(shared.value, (xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) for t in terms), len(terms))
            return pa.RecordBatch.from_pydict({"term": pa.array([terms[i] for i in ok], pa.string()), "n": pa.array([n[terms[i]] for i in ok], pa.int64())})

        for batch in batches:
            for text in batch.column(0):
                n.update(set(_TERM.findall(text.as_py().lower())))
                if len(n) > 400_000:
                    yield passing()
                    n.clear()
        yield passing()

    counts = docs.select(text_of(text_col).alias("text")).mapInArrow(count, "term string, n long")
    return counts.groupBy("term").agg(F.sum("n").alias("n_t")).join(candidates, "term")


def revealing_pairs(rows: DataFrame, docs: DataFrame, text_col: str, support: int, least: float) -> DataFrame:
    """(entity, term, n_ct, disclosure) of the pairs whose disclosure reaches `least`."""
    total = float(rows.count())
    n_c = rows.where(F.size("entities") > 0).select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    n_c = materialise(n_c.where((F.col("n_c") >= support) & (F.col("n_c") < total)))
    pairs = materialise(pair_counts(rows, n_c).where(F.col("n_ct") >= support))
    candidates = materialise(pairs.select("term").distinct())
    if candidates.isEmpty():
        return pairs.withColumn("disclosure", F.lit(0.0)).limit(0)

    def disclosing(counts: DataFrame) -> DataFrame:
        out = pairs.join(n_c, "entity").join(counts, "term")
        pmi = F.log2(F.col("n_ct") * total / (F.col("n_c") * F.col("n_t")))
        out = out.withColumn("disclosure", pmi / F.log2(F.lit(total) / F.col("n_c")))
        return materialise(out.where(F.col("disclosure") >= least).select("entity", "term", "n_ct", "disclosure"))

    # A term is in no fewer documents than in those that hold an entity. Counts of these alone rule out most pairs, those of
    # frequent words, before the whole corpus is counted.
    pairs = disclosing(document_frequency(rows.where(F.size("entities") > 0), candidates, "text")).drop("disclosure")
    candidates = materialise(pairs.select("term").distinct())
    return disclosing(document_frequency(docs, candidates, text_col))


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = 3,
    generalise_at: float = 0.8,
    remove_at: float = 0.95,
    keys: bool = False,
) -> DataFrame:
    """Per row of `docs`: the id, base (its base spans) and spans (all spans), as arrays of (start, rank, end, kind, action).

    With `keys`, id, h1 and h2 (the text's content key) instead of the id under its own name.
    """
    rows = scan(docs, id_col, text_col)
    pairs = revealing_pairs(rows, docs, text_col, support, generalise_at)
    held = materialise(places(rows, pairs))
    # A pair is in as many of these rows as it has documents.
    hot = F.col("n_ct") > max(1000, held.count() // HOT_PAIRS)
    key = ["entity", "term"]
    first = held.join(F.broadcast(pairs.where(hot).drop("n_ct")), key, "left")
    done = first.where("disclosure is not null")
    rest = first.where("disclosure is null").drop("disclosure").join(pairs.where(~hot).drop("n_ct"), key)
    found = done.select("uid", "term", "at", "disclosure").unionByName(rest.select("uid", "term", "at", "disclosure"))
    found = found.groupBy("uid", "term").agg(F.first("at").alias("at"), F.max("disclosure").alias("d"))
    action = F.when(F.col("d") >= remove_at, "remove").otherwise("generalise")
    one = F.transform("at", lambda a: F.struct(a["start"].alias("start"), F.lit(KINDS.index("term")).alias("rank"), a["end"].alias("end"), F.lit("term").alias("kind"), action.alias("action")))
    # A document holds no more of these than it has words.
    found = found.groupBy("uid").agg(F.flatten(F.collect_list(one)).alias("terms"))
    out = rows.select("uid", "id", "h1", "h2", "base").join(found, "uid", "left")
    spans = F.sort_array(F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat("base", "terms")))
    return out.select(*(["id", "h1", "h2"] if keys else [F.col("id").alias(id_col)]), "base", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(text: str, spans: list) -> str:
    """The text with base spans replaced by [KIND], revealing terms removed or replaced by their class."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] < at:
            continue
        piece = text[s["start"] : s["end"]]
        out.append(text[at : s["start"]])
        if s["kind"] != "term":
            out.append(f"[{s['kind'].upper()}]")
        elif s["action"] == "generalise":
            out.append("[NUMBER]" if any(c.isdigit() for c in piece) else "[NAME]" if piece[:1].isupper() else "[WORD]")
        at = s["end"]
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with every text sanitised, all other columns as they are.

    Spans go to rows by id and content: rows that agree in both have the same spans.
    """
    text = text_of(text_col)
    h1, h2 = content_key(text)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"), h1.alias("h1"), h2.alias("h2"))
    spans = find_pii(docs, id_col, text_col, keys=True, **options).where(F.size("spans") > 0)
    spans = spans.select(F.col("id").alias("i"), F.col("h1").alias("a"), F.col("h2").alias("b"), "spans").dropDuplicates(["i", "a", "b"])
    rows = rows.join(spans, same(rows, spans, {"id": "i", "h1": "a", "h2": "b"}), "left")

    @F.pandas_udf("string")
    def clean(texts, all_spans):
        return texts.combine(all_spans, lambda t, s: t if s is None or t is None else sanitised(t, list(s)))

    cleaned = rows.withColumn("cleaned", clean(F.col("text"), F.col("spans")))
    return cleaned.select(*[F.col("cleaned").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
