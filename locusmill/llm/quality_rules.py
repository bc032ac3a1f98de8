"""Quality rules by distribution divergence, in DataFrame operations only.

Counts of the text (words, symbols, repeated lines, words in repeated five-word windows) give the
base verdict. The divergence verdict compares two histograms of the document with those of its
language, pooled over all its documents in the corpus: classes of characters, and the common words
of the language against all other words. These are listed for some languages; for any other value
of the language column they are its COMMON most frequent words in the corpus. The measure is the Jensen-Shannon distance (base 2, square
root, 0 to 1); each comparison is made only where the document is long enough for its histogram to
mean something (`min_chars`, `min_words`).

Histograms are summed per language by one aggregate. References of languages without a list that
hold over 1/HOT_LANGUAGES of the rows go to the documents by broadcast, of the others by a join.

Edge cases: a null text is empty (base_failed, as it has fewer than 10 words); a language that
is null or "", or has no list and fewer than LEAST_DOCUMENTS documents, is compared by its characters with
the pool of all documents only; an empty
table gives an empty result. Rows are judged one by one, so ties and repeated rows agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialise, text_of

#: Frequent function words by language.
COMMON_WORDS = {
    "de": "der die das und in zu den von mit ist nicht ein eine auf für sich dem als auch des".split(),
    "en": "the of and to in a is that for it as was with be by on not are this from".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par sur pas au avec".split(),
}
#: Classes of characters; what is in none of them is the last bin.
CLASSES = {"lower": r"\p{Ll}+", "space": r"[\x20\x09-\x0D]+", "upper": r"\p{Lu}+", "digit": r"\p{Nd}+", "symbol": r"[#*$%&|<>]+", "punct": r"\p{P}+"}
BINS = [*CLASSES, "other"]
WINDOW = 5
#: A language without a list has references of its own from so many documents on.
LEAST_DOCUMENTS = 20
#: So many of its most frequent words are its common words.
COMMON = 20
#: No more than this many languages can be hot.
HOT_LANGUAGES = 2000


def _characters(docs: DataFrame) -> DataFrame:
    """Adds one count of code points per class of CLASSES and "other", as columns c_<class>.

    Each class is taken out of what the ones before have left, so that only the first expression
    sees the whole text.
    """
    left, out = F.col("__text"), docs
    for name, pattern in CLASSES.items():
        out = out.withColumn("__rest", F.regexp_replace(left, pattern, ""))
        out = out.withColumn(f"c_{name}", (F.length(left) - F.length("__rest")).cast("long")).drop("__left").withColumnRenamed("__rest", "__left")
        left = F.col("__left")
    return out.withColumn("c_other", F.length("__left").cast("long")).drop("__left")


def _is_in(values: list[str]):
    return lambda w: w.isin(values)


def _common(words: Column, lang: Column, own: bool = False) -> Column:
    """Counts of the language's common words, then of all other words; null without common words."""
    out = F.lit(None).cast("array<long>")
    if own:
        counts = F.transform("__own", lambda c: F.size(F.filter("__common", lambda w: w == c)).cast("long"))
        out = F.concat(counts, F.array((F.size(words) - F.size("__common")).cast("long")))
    for code, common in COMMON_WORDS.items():
        counts = F.array(*[F.size(F.filter("__common", _is_in([c]))).cast("long") for c in common])
        out = F.when(lang == code, F.concat(counts, F.array((F.size(words) - F.size("__common")).cast("long")))).otherwise(out)
    return out


def histograms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", own: bool = False) -> DataFrame:
    """`docs` with __words, __chars and __common_counts; with `own`, common words of a language without a list come from __own."""
    out = _characters(docs.withColumn("__text", text_of(text_col)))
    out = out.withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    listed = F.filter(F.transform("__words", F.lower), lambda w: F.array_contains("__own", w)) if own else F.lit(None).cast("array<string>")
    for code, common in COMMON_WORDS.items():
        listed = F.when(F.col(lang_col) == code, F.filter(F.transform("__words", F.lower), _is_in(common))).otherwise(listed)
    out = out.withColumn("__common", listed)
    out = out.withColumn("__common_counts", _common(F.col("__words"), F.col(lang_col), own)).drop("__common")
    return out.withColumn("__chars", F.array(*[F.col(f"c_{c}") for c in BINS]))


def language_sums(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(__key, documents, c0.., w0..): the summed histograms of each language, by one aggregate over the whole corpus."""
    rows = histograms(docs.select(text_col, lang_col), text_col, lang_col)
    most = max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(F.col("__chars")[i]).alias(f"c{i}") for i in range(len(BINS))]
    sums += [F.sum(F.get("__common_counts", F.lit(i))).alias(f"w{i}") for i in range(most)]
    return materialise(rows.groupBy(F.col(lang_col).alias("__key")).agg(F.count(F.lit(1)).alias("documents"), *sums))


def references(sums: DataFrame) -> dict[str, dict[str, list[float]]]:
    """The histograms of each language that has a word list, and of all documents ("")."""
    out: dict[str, dict[str, list[float]]] = {}
    for row in sums.where(F.col("__key").isin(list(COMMON_WORDS))).collect():
        bins = len(COMMON_WORDS[row["__key"]]) + 1
        out[row["__key"]] = {"chars": [float(row[f"c{i}"] or 0) for i in range(len(BINS))], "words": [float(row[f"w{i}"] or 0) for i in range(bins)]}
    pool = sums.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(BINS))]).first()
    out[""] = {"chars": [float(pool[f"c{i}"] or 0) for i in range(len(BINS))], "words": []}
    for x in out.values():
        for k, v in x.items():
            total = sum(v)
            x[k] = [y / total for y in v] if total else []
    return out


def other_languages(docs: DataFrame, sums: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(__key, documents, __own_chars, __own, __own_words) of the languages without a list: references and common words."""
    chars = F.array(*[F.col(f"c{i}").cast("double") for i in range(len(BINS))])
    total = F.aggregate(chars, F.lit(0.0), lambda a, x: a + x)
    known = sums.where(~F.col("__key").isin(list(COMMON_WORDS)) & (F.col("__key") != "") & (F.col("documents") >= LEAST_DOCUMENTS))
    known = known.select("__key", "documents", F.when(total > 0, F.transform(chars, lambda x: x / total)).alias("__own_chars"))
    rows = docs.where(~F.col(lang_col).isin(list(COMMON_WORDS)) & (F.col(lang_col) != ""))
    words = rows.select(F.col(lang_col).alias("__key"), F.explode(F.transform(F.regexp_extract_all(text_of(text_col), F.lit(WORD), F.lit(0)), F.lower)).alias("word"))
    counts = words.groupBy("__key", "word").agg(F.count(F.lit(1)).alias("n"))
    # The most frequent words of each salt, then of the language: no task has a whole vocabulary.
    counts = counts.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(64)))
    order = [F.desc("n"), "word"]
    sifted = counts.withColumn("all", F.sum("n").over(Window.partitionBy("__key", "salt")))
    sifted = sifted.withColumn("r", F.row_number().over(Window.partitionBy("__key", "salt").orderBy(*order))).where(F.col("r") <= COMMON)
    per = sifted.groupBy("__key", "salt").agg(F.first("all").alias("all"), F.collect_list(F.struct((-F.col("n")).alias("n"), "word")).alias("top"))
    per = per.groupBy("__key").agg(F.sum("all").alias("all"), F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, COMMON).alias("top"))
    held = F.aggregate("top", F.lit(0).cast("long"), lambda a, x: a - x["n"])
    shares = F.concat(F.transform("top", lambda x: -x["n"] / F.col("all")), F.array((F.col("all") - held) / F.col("all")))
    return materialise(known.join(per.select("__key", F.col("top.word").alias("__own"), shares.alias("__own_words")), "__key", "left"))


def with_own(docs: DataFrame, languages: DataFrame, total: int, lang_col: str) -> DataFrame:
    """`docs` with the references of their language from `languages`, null where it has none."""
    hot = F.col("documents") > max(1000, total // HOT_LANGUAGES)
    columns = [*docs.columns, "__own_chars", "__own", "__own_words"]
    first = docs.join(F.broadcast(languages.where(hot)), docs[lang_col] == F.col("__key"), "left")
    if languages.where(~hot).isEmpty():
        return first.select(*columns)
    cold = F.col("__key").isNull() & F.coalesce(~F.col(lang_col).isin(list(COMMON_WORDS)) & (F.col(lang_col) != ""), F.lit(False))
    rest = first.where(cold).select(*docs.columns)
    rest = rest.join(languages.where(~hot), rest[lang_col] == F.col("__key"), "left")
    return first.where(~cold).select(*columns).unionByName(rest.select(*columns))


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from a distribution, 0 to 1; null if either is empty."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    p = F.transform(counts, lambda x: x / F.when(total > 0, total))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, reference, lambda x, q: (part(x, (x + q) / 2) + part(q, (x + q) / 2)) / 2)
    return F.when((total > 0) & reference.isNotNull(), F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))))


def _literal(values: list[float]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.lit(None).cast("array<double>")


def repeated_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words from __words: words inside five-word windows that occur twice or more.

    Hashes of the windows tell the texts without any repeat, most of them; the others compare the
    windows themselves, sorted.
    """
    at = lambda i, k: F.get("__words", i + k)
    n = F.size("__words") - (WINDOW - 1)
    hashes = F.transform(F.slice("__words", 1, F.greatest(n, F.lit(0))), lambda w, i: F.xxhash64(w, *[at(i, k) for k in range(1, WINDOW)]))
    out = docs.withColumn("__hashes", hashes)
    some = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    window = lambda h, i: F.struct(F.concat_ws(" ", *[at(i, k) for k in range(WINDOW)]).alias("w"), i.alias("i"))
    out = out.withColumn("__sorted", F.when(some, F.sort_array(F.transform("__hashes", window))))
    near = lambda x, i, k: F.coalesce(F.get("__sorted", i + k)["w"] == x["w"], F.lit(False))
    starts = F.sort_array(F.array_compact(F.transform("__sorted", lambda x, i: F.when(near(x, i, -1) | near(x, i, 1), x["i"]))))
    out = out.withColumn("__starts", starts)
    covered = F.transform("__starts", lambda x, i: F.least(F.coalesce(F.get("__starts", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    return out.drop("__hashes", "__sorted", "__starts")


#: The columns that `judge` adds.
VERDICTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars_distance", "words_distance", "base_failed", "kept")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """`docs` with the columns of VERDICTS; columns of `docs` with these names give way, all others stay whatever their names."""
    rows = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__t"), F.col(lang_col).alias("__l"))
    judged = _judged(rows, "__t", "__l", **limits)
    return judged.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns if c not in VERDICTS], *VERDICTS)


def _judged(
    docs: DataFrame,
    text_col: str,
    lang_col: str,
    max_chars_distance: float = 0.27,
    max_words_distance: float = 0.25,
    min_chars: int = 200,
    min_words: int = 100,
) -> DataFrame:
    """`docs`, of which no column has a name of these, with the columns of VERDICTS."""
    sums = language_sums(docs, text_col, lang_col)
    ref = references(sums)
    # A text without a language is set against all texts; a language that has no reference of its own gives no verdict.
    chars, words = F.when(F.coalesce(F.col(lang_col), F.lit("")) == "", _literal(ref[""]["chars"])), _literal([])
    others = sums.where(~F.col("__key").isin(list(COMMON_WORDS)) & (F.col("__key") != "") & (F.col("documents") >= LEAST_DOCUMENTS))
    own = not others.isEmpty()
    if own:
        total = sums.agg(F.sum("documents")).first()[0]
        docs = with_own(docs, other_languages(docs, sums, text_col, lang_col), total, lang_col)
        chars, words = F.coalesce(F.col("__own_chars"), chars), F.col("__own_words")
    out = repeated_words(histograms(docs, text_col, lang_col, own))
    for code in COMMON_WORDS:
        if code in ref:
            chars = F.when(F.col(lang_col) == code, _literal(ref[code]["chars"])).otherwise(chars)
            words = F.when(F.col(lang_col) == code, _literal(ref[code]["words"])).otherwise(words)
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))
    out = out.withColumn("__lines", lines)
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.col("c_lower") + F.col("c_upper") + F.col("c_digit") + F.col("c_symbol") + F.col("c_punct") + F.col("c_other"),
        "n_symbols": F.col("c_symbol"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "chars_distance": js_distance(F.col("__chars"), chars),
        "words_distance": js_distance(F.col("__common_counts"), words),
    })
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    far = (F.col("word_chars") >= min_chars) & (F.coalesce("chars_distance", F.lit(0.0)) > max_chars_distance)
    far |= (F.col("n_words") >= min_words) & (F.coalesce("words_distance", F.lit(0.0)) > max_words_distance)
    out = out.withColumn("kept", ~F.col("base_failed") & ~far)
    return out.drop("__text", "__words", "__chars", "__common_counts", "__lines", "__own_chars", "__own", "__own_words", *[f"c_{c}" for c in BINS])




def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns whatever their names."""
    rows = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__t"), F.col(lang_col).alias("__l"))
    judged = _judged(rows, "__t", "__l", **limits).select("__row", "kept")
    # A filter goes down through projections and would repeat their expressions; it stops at a metric.
    judged = judged.observe(f"judged_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("documents"), F.count_if("kept").alias("kept"))
    return judged.where("kept").select("__row.*")
