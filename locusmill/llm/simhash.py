"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are made in one pass over the texts. Distinct fingerprints then meet wherever they
can be within `bits` differing bits: 64 bits in `bits + 1` blocks leave at least one block equal,
so every fingerprint goes once per block to the group of its block's value (blocks are rotated to
the front; the group is a subtree of the trie over the rotated fingerprints). Within a group, the
trie over the sorted fingerprints is joined with itself: pairs of nodes go down together, the
differing bits of their paths add up, and a pair is dropped once they pass `bits`. A pair whose
two nodes already lie wholly in one component is dropped too, so that a dense family of near
copies costs no more than it takes to connect it; the links given out are a spanning forest of
the group, which loses no connection and is never larger than the group.

A group with more than `split` fingerprints (a hot block value) is not left to one task: the bits
that its members do not share yet are cut into `bits + 1` blocks in turn, of which again one is
equal in any pair, and so on until no group is larger (see `links`). A group whose members differ
in w bits at most has 2^w fingerprints, so this ends. Components over all links come from rounds
of contraction (operators.graph), each written to the shared folder.

Documents share their fingerprint's class in a last join, where the few largest groups of equal
fingerprints (at most HOT_GROUPS) go by broadcast and the rest by hash.

Edge cases: null and empty texts, and texts without a word, have fingerprint zero and link like any
other; a text with fewer words than a shingle is one shingle; rows that repeat an id are rows of
their own, of which `drop_near_copies` keeps one per group like of any others; a null id is never
the smallest while another is there; columns other than id and text are not looked at, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import content_key, hot_join, materialise, one_of_equal, same, text_of

#: No more than this many groups can be hot.
HOT_GROUPS = 2000
#: Bit counts are summed over this many shingles at a time.
CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash over XXH64 of the shingles, as an unsigned integer."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII space
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(whole, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts, n = np.zeros(64, np.int64), len(words) - shingle + 1
    starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for i in range(0, n, CHUNK):
        h = np.array([xxh64_intdigest(whole[a:b], seed) for a, b in zip(starts[i : i + CHUNK], ends[i : i + CHUNK])], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Per row of `docs`: id, fp (the 64 bits as a signed long), h1 and h2 (the text's content key)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64()), batch.column(2), batch.column(3)], names=["id", "fp", "h1", "h2"])

    text = text_of(text_col)
    h1, h2 = content_key(text)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))
    return rows.mapInArrow(scan, "id long, fp long, h1 long, h2 long")


# ---------------------------------------------------------------- the trie self-join
def _hook(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i]; comp[i] is the smallest member of i's component."""
    while True:
        x, y = comp[a], comp[b]
        if not (x != y).any():
            return
        np.minimum.at(comp, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = comp[comp]
            if (up == comp).all():
                break
            comp[:] = up


def trie_components(values: np.ndarray, starts: np.ndarray, bits: int, width: int = 64, small: int = 64, chunk: int = 1 << 16) -> np.ndarray:
    """For each value: the index of the first value of its group that steps of <= bits connect it with.

    values: uint64, ascending and distinct within each group; starts: where the groups start, and
    the end. A node is a range of one group that shares `level` leading bits. Node pairs go down
    level by level, most recent first and equal nodes before unequal ones, so that near families
    are connected before distant nodes of them meet.
    """
    comp = np.arange(len(values))
    roots = np.column_stack((starts[:-1], starts[1:], starts[:-1], starts[1:], np.zeros(len(starts) - 1, np.int64)))
    stack = [(0, roots[roots[:, 1] - roots[:, 0] > 1])]
    while stack:
        level, pairs = stack.pop()
        if len(pairs) > chunk:
            stack += [(level, pairs[chunk:]), (level, pairs[:chunk])]
            continue
        if level and len(pairs):
            # Nodes that lie in one component together have nothing left to find.
            turns = np.concatenate(([0], np.cumsum(comp[1:] != comp[:-1])))
            a0, a1, b0, b1, _ = pairs.T
            one = (turns[a0] == turns[a1 - 1]) & (turns[b0] == turns[b1 - 1]) & (comp[a0] == comp[b0])
            pairs = pairs[~one]
        if not len(pairs):
            continue
        a0, a1, b0, b1, diff = pairs.T
        leaf = (a1 - a0) * (b1 - b0) <= small if level < width else np.ones(len(pairs), bool)
        if leaf.any():
            x0, x1, y0, y1, _ = pairs[leaf].T
            w = y1 - y0
            sizes = (x1 - x0) * w
            k = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            w, i, j = np.repeat(w, sizes), np.repeat(x0, sizes), np.repeat(y0, sizes)
            i, j = i + k // w, j + k % w
            near = np.bitwise_count(values[i] ^ values[j]) <= bits
            _hook(comp, i[near], j[near])
            a0, a1, b0, b1, diff = pairs[~leaf].T
        if not len(a0):
            continue
        # Where the next bit turns to one in each node.
        bit = np.uint64(1) << np.uint64(width - 1 - level)
        ones = np.concatenate(([0], np.cumsum((values & bit) != 0)))
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = (a0 == b0) & (a1 == b1)
        kids = [
            np.column_stack((a0, am, bm, b1, diff + 1)),
            np.column_stack((am, a1, b0, bm, diff + 1))[~same],
            np.column_stack((a0, am, b0, bm, diff)),
            np.column_stack((am, a1, bm, b1, diff)),
        ]
        kids = [k[(k[:, 0] < k[:, 1]) & (k[:, 2] < k[:, 3]) & (k[:, 4] <= bits)] for k in kids]
        across, down = np.concatenate(kids[:2]), np.concatenate(kids[2:])
        if len(across):
            stack.append((level + 1, across))
        if len(down):
            stack.append((level + 1, down))
    return comp


def _dealt(rows: DataFrame, width: int, bits: int) -> tuple[DataFrame, int]:
    """Rows (fp, rest, g) once per block of the `width` bits in `rest`, g the finer group and rest without that block; the largest width left.

    Fingerprints of a group agree in all bits outside `rest`; of the bits + 1 blocks of the others, one at least is equal in any pair.
    """
    cuts = [round(width * k / (bits + 1)) for k in range(bits + 2)]
    finer = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        low = width - b
        mask = F.lit((1 << low) - 1).cast("long")
        front = F.shiftrightunsigned("rest", width - a) if a else F.lit(0).cast("long")
        value = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
        finer.append(F.struct(F.xxhash64("g", F.lit(k), value).alias("g"), F.shiftleft(front, low).bitwiseOR(F.col("rest").bitwiseAND(mask)).alias("rest")))
    return rows.select("fp", F.explode(F.array(*finer)).alias("x")).select("fp", "x.rest", "x.g"), width - min(b - a for a, b in zip(cuts, cuts[1:]))


def links(distinct: DataFrame, bits: int = 3, split: int = 200_000, tasks: int | None = None) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints `fp`, such that steps of <= bits connect the same fingerprints."""
    rows, width = _dealt(distinct.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("g")), 64, bits)
    members = None
    while True:
        # Few groups are larger than `split`: at most (bits + 1) * rows / split of them.
        hot = None
        if 1 << width > split:
            hot = materialise(rows.groupBy("g").count().where(F.col("count") > split).select("g"))
            if hot.isEmpty():
                hot = None
        cold = rows if hot is None else rows.join(F.broadcast(hot), "g", "left_anti")
        cold = cold.select("fp", "g")
        members = cold if members is None else members.unionByName(cold)
        if hot is None:
            break
        rows, width = _dealt(rows.join(F.broadcast(hot), "g", "left_semi"), width, bits)
        rows = materialise(rows)

    def join_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        """All groups of `pdf` at once: a forest of tries, one root per group."""
        fp, g = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["g"].to_numpy()
        order = np.lexsort((fp, g))
        fp, g = fp[order], g[order]
        starts = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(fp)]))
        comp = trie_components(fp, starts, bits)
        at = np.flatnonzero(fp != fp[comp])
        return pd.DataFrame({"u": fp[at].view(np.int64), "v": fp[comp[at]].view(np.int64)})

    n = tasks or int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = members.repartition(n, "g").sortWithinPartitions("g")
    return members.mapInPandas(by_group("g", join_groups), "u long, v long").distinct()


def by_group(column: str, run) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Calls `run` with frames of whole groups; rows come sorted by `column`, and a batch's last group may go on in the next."""

    def partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            g = pdf[column].to_numpy()
            last = np.flatnonzero(g != g[-1])
            cut = last[-1] + 1 if len(last) else 0
            if held and (cut or held[-1][column].iloc[-1] != g[0]):
                yield run(pd.concat([*held, pdf.iloc[:cut]]))
                held = []
            elif cut:
                yield run(pdf.iloc[:cut])
            held.append(pdf.iloc[cut:])
        if held:
            yield run(pd.concat(held))

    return partition


# ---------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over edges(u, v), for every node that has an edge."""
    return connected_components(edges).select("node", F.col("component").alias("root"))


def _classes(rows: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """(node, n, component_id, i, k1, k2) per node of rows(id, h1, h2, node): its rows, its component's smallest id and the row that stays of it."""
    key = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("i"), F.col("h1").alias("k1"), F.col("h2").alias("k2")))
    distinct = materialise(rows.groupBy(node).agg(F.count(F.lit(1)).alias("n"), key.alias("key")))
    roots = components(edges).select(F.col("node").alias(node), "root")
    classes = distinct.join(roots, node, "left").withColumn("root", F.coalesce("root", node))
    least = classes.groupBy("root").agg(F.min("key").alias("key"))
    return materialise(classes.drop("key").join(least, "root").select(node, "n", F.col("key.i").alias("component_id"), "key.i", "key.k1", "key.k2"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3, shingle: int = 3) -> DataFrame:
    """Per row of `docs`: the id, fingerprint (16 hex digits), component_id, n_equal (rows of the same fingerprint)."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle))
    classes = _classes(rows, "fp", links(rows.select("fp").distinct(), bits))
    out = hot_join(rows, classes, "fp", "n", rows.count(), HOT_GROUPS)
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", F.col("n").alias("n_equal"))


def only_firsts(docs: DataFrame, rows: DataFrame, classes: DataFrame, node: str, id_col: str, text_col: str) -> DataFrame:
    """One row of `docs` per component, the one of the smallest id, with all columns.

    rows: id, h1, h2, node of every row of `docs`; classes: as of `_classes`. Rows go by id and content, so that no text is lost where ids repeat.
    """
    found = hot_join(rows, classes, node, "n", rows.count(), HOT_GROUPS)
    stays = F.col("id").eqNullSafe(F.col("i")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    found = materialise(found.select(F.col("id").alias("__i"), F.col("h1").alias("__a"), F.col("h2").alias("__b"), stays.alias("stays")))
    gone = found.where("not stays").select("__i", "__a", "__b").distinct()
    keys = ["__id", "__h1", "__h2"]
    repeats = found.where("stays").groupBy(F.col("__i").alias("__id"), F.col("__a").alias("__h1"), F.col("__b").alias("__h2")).count().where("count > 1")
    h1, h2 = content_key(text_of(text_col))
    out = docs.select(F.struct("*").alias("__row"), F.col(id_col).cast("long").alias("__id"), h1.alias("__h1"), h2.alias("__h2"))
    out = out.join(gone, same(out, gone, dict(zip(keys, ("__i", "__a", "__b")))), "left_anti")
    return one_of_equal(out, repeats, keys).select("__row.*")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3, shingle: int = 3) -> DataFrame:
    """One row of each group of fingerprints that steps of <= bits connect, the one of the smallest id, with all columns."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle))
    classes = _classes(rows, "fp", links(rows.select("fp").distinct(), bits))
    return only_firsts(docs, rows, classes, "fp", id_col, text_col)
