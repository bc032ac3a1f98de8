"""Near copies at a similarity: SimHash over wide budgets, routed by minima and settled by sketches.

Two texts are near copies where the Jaccard similarity of their sets of `shingle`-word shingles is
`similarity` or more. At 0.8 their 64-bit SimHashes differ in about ten bits, too many for blocks
of equal bits to tell where they meet. So the trie self-join of `simhash` runs in other groups:
each of MINIMA permutations of the hashes has a smallest one in every text, and texts of similarity
s share any such minimum with probability s. At 0.8, all four are missed once in 600 pairs. Within
a group of texts that share a minimum, node pairs of the trie go down together and are pruned once
their differing bits pass `bits`; what is left are families of candidates.

Within a family, a text is compared with those of at most `bits` differing bits that no text
linked before has reached, by sketches: LANES further minima of each set, of which two sets share
a part as large as their similarity (standard error 0.025 at 0.8 with 256 of them; `slack` below
the similarity is still a link, so that few pairs at the limit are missed). A family of mutual
copies thus costs about one comparison a text. Links go on to connected components.

No group is left to one task: texts of a minimum that more than `split` share meet by pairs of
minima instead, of which the second is any of ALL_MINIMA (two texts of similarity 0.8 that share
one share none of the other seven once in 78,000 pairs), texts of a pair that is too large still by
three, and so on to DEEPEST; what more than `split` share then counts as a family without a trie. A family
larger than `split` is dealt to chunks, whose parts meet through the first texts
of each part, round by round; parts that this does not make fewer meet chunk by chunk, all with all.
First texts may miss what others of their parts are linked with, so in the end every text outside of
a large family's largest component meets all texts of the family, chunk by chunk.

Edge cases: a text with fewer words than a shingle is one shingle; texts without a word have no
shingle and are near copies of each other alone; equal sets of shingles are one entry, whatever
the number of their rows, so repeated rows, ties and null texts need no comparison; words are as
in `simhash`. Ids may repeat or be null: rows go by id and content. Other columns are not looked
at, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content_key, materialise, text_of
from .simhash import CHUNK, _classes, by_group, components, only_firsts, trie_components

#: Minima that route every text, minima that also part the hot groups, and how many at once at most.
MINIMA, ALL_MINIMA, DEEPEST = 4, 8, 4
LANES = 256


def shingle_hashes(text: str, shingle: int, seed: int = 42) -> np.ndarray:
    """Distinct XXH64 of a text's shingles, ascending."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(whole, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    return np.unique(np.fromiter((xxh64_intdigest(whole[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())), np.uint64, n))


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers whose values look drawn."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _bits(h: np.ndarray) -> int:
    """The SimHash of distinct shingle hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), CHUNK):
        counts += np.unpackbits(h[i : i + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h)).tobytes(), "big")


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per row: id, h1, h2, node (the set's own hash), fp, minima (null without a shingle) and sketch (2 bytes a lane)."""
    salts = _mix(np.arange(1, ALL_MINIMA + LANES + 1, dtype=np.uint64))
    lanes = (salts[ALL_MINIMA:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shifts = (salts[ALL_MINIMA:] & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            node, fp, minima, sketch = [], [], [], []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py(), shingle)
                node.append(xxh64_intdigest(h.tobytes()))
                fp.append(_bits(h))
                minima.append([int(_mix(h ^ s).min()) for s in salts[:ALL_MINIMA]] if len(h) else None)
                with np.errstate(over="ignore"):
                    low, least = (h >> np.uint64(20)).astype(np.uint32), np.full(LANES, 0xFFFFFFFF, np.uint32)
                    for i in range(0, len(low), 2048):
                        np.minimum(least, ((low[i : i + 2048, None] ^ shifts) * lanes).min(axis=0), out=least)
                sketch.append(_folded(least).tobytes())
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())
            least = pa.array([None if m is None else np.array(m, np.uint64).view(np.int64) for m in minima], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), signed(node), signed(fp), least, pa.array(sketch, pa.binary())], names=["id", "h1", "h2", "node", "fp", "minima", "sketch"])

    text = text_of(text_col)
    h1, h2 = content_key(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))
    return rows.mapInArrow(scan, "id long, h1 long, h2 long, node long, fp long, minima array<long>, sketch binary")


def _folded(x: np.ndarray) -> np.ndarray:
    """32-bit minima, of which the leading bits are mostly zero, as 16 bits."""
    with np.errstate(over="ignore"):
        return ((x * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def settled(fp: np.ndarray, sketches: np.ndarray, bits: int, least: float) -> np.ndarray:
    """For each text of a family: the first text that links of at most `bits` bits and at least `least` equal lanes connect it with."""
    n, need = len(fp), int(np.ceil(least * sketches.shape[1]))
    first = np.full(n, -1)
    for seed in range(n):
        if first[seed] >= 0:
            continue
        first[seed] = seed
        todo = [seed]
        while todo:
            x = todo.pop()
            free = np.flatnonzero(first < 0)
            free = free[np.bitwise_count(fp[free] ^ fp[x]) <= bits]
            found = free[np.count_nonzero(sketches[free] == sketches[x], axis=1) >= need]
            first[found] = seed
            todo += found.tolist()
    return first


def groups_of(nodes: DataFrame, split: int) -> tuple[DataFrame, DataFrame]:
    """(node, fp, g) of groups of at most `split` nodes, and (node, g) of the groups that stay larger: see the module."""
    keys = F.transform("minima", lambda m, k: F.xxhash64(k, m))
    level = nodes.select("node", "fp", keys.alias("keys")).withColumn("own", F.explode(F.transform(F.slice("keys", 1, MINIMA), lambda x: F.array(x))))
    members = []
    for deep in range(1, DEEPEST + 1):
        level = materialise(level.withColumn("g", F.xxhash64("own")))
        sizes = materialise(level.groupBy("g").count().where("count > 1"))
        # Groups above `split`: at most as many as rows of the level / split.
        hot = materialise(sizes.where(F.col("count") > split).select("g"))
        members.append(level.join(sizes.where(F.col("count") <= split).select("g"), "g").select("node", "fp", "g"))
        level = level.join(F.broadcast(hot), "g")
        if deep == DEEPEST or hot.isEmpty():
            break
        # One more minimum; a set of them is one group, in whatever order it came about.
        more = F.array_except("keys", "own")
        level = level.withColumn("more", F.explode(more)).select("node", "fp", "keys", F.array_sort(F.array_append("own", F.col("more"))).alias("own"))
        level = level.dropDuplicates(["node", "own"])
    out = members[0]
    for x in members[1:]:
        out = out.unionByName(x)
    return out, level.select("node", "g")


def near_links(rows: DataFrame, bits: int, least: float, split: int) -> DataFrame:
    """Links (u, v) between nodes of `rows` (node, fp, minima, sketch) that connect all near copies."""
    nodes = materialise(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("minima").alias("minima"), F.first("sketch").alias("sketch")).where("minima is not null"))
    n_tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members, whole = groups_of(nodes, split)
    members = members.select("node", "fp", "g").repartition(n_tasks, "g").sortWithinPartitions("g")

    def families(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, g, node = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["g"].to_numpy(), pdf["node"].to_numpy()
        order = np.lexsort((node, fp, g))
        fp, g, node = fp[order], g[order], node[order]
        # Equal fingerprints of a group are one leaf.
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (fp[1:] != fp[:-1])))
        leaf = np.cumsum(new) - 1
        own = g[new]
        starts = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]))
        root = trie_components(fp[new], starts, bits)[leaf]
        many = np.bincount(root, minlength=len(own))[root] > 1
        # The family's name is its group and first leaf.
        return pd.DataFrame({"g": g[many], "c": fp[new][root[many]].view(np.int64), "node": node[many]})

    found = members.mapInPandas(by_group("g", families), "g long, c long, node long").select(F.xxhash64("g", "c").alias("f"), "node")
    found = materialise(found.unionByName(whole.select(F.col("g").alias("f"), "node")).distinct())

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in pdf.groupby("f", sort=False):
            own = own.sort_values("node")
            fp, node = own["fp"].to_numpy(np.int64).view(np.uint64), own["node"].to_numpy()
            first = settled(fp, np.frombuffer(b"".join(own["sketch"]), np.uint16).reshape(len(fp), LANES), bits, least)
            out.append(pd.DataFrame({"f": own["f"].to_numpy(), "node": node, "first": node[first], "rank": _ranks(first)}))
        return pd.concat(out)

    def linked(dealt: DataFrame) -> DataFrame:
        """(f, node, first, rank) of dealt (f, node), each f by one task."""
        whole = dealt.join(sketches, "node").repartition(n_tasks, "f").sortWithinPartitions("f")
        return materialise(whole.select("f", "node", "fp", "sketch").mapInPandas(by_group("f", settle), "f long, node long, first long, rank long"))

    sketches, links = nodes.select("node", "fp", "sketch"), []
    families_of, large = found, None
    while True:
        sizes = found.groupBy("f").count().where(F.col("count") > split)
        big = materialise(sizes.select("f", "count", F.ceil(F.col("count") / split).cast("int").alias("chunks")))  # at most rows / split
        dealt = found.join(F.broadcast(big), "f", "left")
        chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        dealt = dealt.withColumn("part", F.when(F.col("chunks").isNull(), F.col("f")).otherwise(F.xxhash64("f", chunk)))
        done = linked(dealt.select(F.col("part").alias("f"), "node"))
        links.append(done)
        if big.isEmpty():
            break
        # The parts of a large family meet through the first texts of each, as long as that makes them fewer.
        firsts = dealt.where("chunks is not null").join(done.where("rank < 2").select(F.col("f").alias("part"), "node"), ["part", "node"])
        firsts = materialise(firsts.select("f", "node", "count", "chunks"))
        left = firsts.groupBy("f").agg(F.count(F.lit(1)).alias("left"), F.first("count").alias("count"), F.first("chunks").alias("chunks"))
        stuck = materialise(left.where(F.col("left") * 2 > F.col("count")).select("f", "chunks"))
        if not stuck.isEmpty():
            # Hardly any of these are near copies, though they share minima and bits: every chunk meets every other.
            rows = found.join(F.broadcast(stuck), "f").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
            rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("own <> other")
            links.append(linked(rows.select(F.xxhash64("f", F.least("own", "other"), F.greatest("own", "other")).alias("f"), "node")))
        if large is None:
            large = big.select("f").join(F.broadcast(stuck.select("f")), "f", "left_anti")
        found = materialise(firsts.select("f", "node").join(F.broadcast(stuck.select("f")), "f", "left_anti"))
        if found.isEmpty():
            break
    if large is not None:
        links.append(linked(_left_apart(families_of.join(F.broadcast(large), "f"), _edges(links), split)))
    return _edges(links).distinct()


def _edges(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))


def _left_apart(members: DataFrame, edges: DataFrame, split: int) -> DataFrame:
    """(f, node) of groups of about `split` in which every text of a family meets each one outside of the family's largest component.

    members: f, node. Texts of one component need no further link, so families that `edges` connect give no row.
    """
    roots = components(edges)
    own = materialise(members.join(roots, "node", "left").select("f", "node", F.coalesce("root", "node").alias("root")))
    sizes = own.groupBy("f", "root").count().groupBy("f").agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.sum("count").alias("all"), F.max("count").alias("most"))
    half = max(1, split // 2)
    sizes = materialise(sizes.where("all > most").select("f", "main", F.ceil(F.col("all") / half).cast("int").alias("n"), F.ceil((F.col("all") - F.col("most")) / half).cast("int").alias("m")))
    rows = own.join(F.broadcast(sizes), "f").withColumns({"a": F.pmod(F.xxhash64("node"), F.col("n")).cast("int"), "b": F.pmod(F.xxhash64("node", F.lit(1)), F.col("m")).cast("int")})
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = rows.withColumn("b", upto("m")).unionByName(rows.where("root <> main").withColumn("a", upto("n")))
    return dealt.select(F.xxhash64("f", "a", "b").alias("f"), "node").distinct()


def _ranks(first: np.ndarray) -> np.ndarray:
    """Each text's number within its part, in order."""
    order = np.argsort(first, kind="stable")
    own = first[order]
    start = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
    out = np.empty(len(first), np.int64)
    out[order] = np.arange(len(first)) - np.repeat(start, np.diff(np.append(start, len(first))))
    return out


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, slack: float = 0.025, bits: int = 16, split: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): id, h1, h2, node of every row of `docs`, and node, n, component_id with the row that stays (see simhash)."""
    rows = materialise(signatures(docs, id_col, text_col, shingle))
    classes = _classes(rows, "node", near_links(rows, bits, similarity - slack, split))
    return rows.select("id", "h1", "h2", "node"), classes


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near copies, the one of the smallest id, with all columns."""
    rows, classes = near_copies(docs, id_col, text_col, **options)
    return only_firsts(docs, rows, classes, "node", id_col, text_col)
