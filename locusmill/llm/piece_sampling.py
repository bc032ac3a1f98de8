"""SentencePiece segmentations by Gumbel top-k sampling without replacement, and decoding.

The lattice of a text has a node before every character and an edge for every piece of the
vocabulary; a character outside the vocabulary is a chain of its UTF-8 bytes. A segmentation is a
path, with probability in proportion to the product of its pieces' weights. The vocabulary is the
given model's; as a BPE model ranks its pieces and gives no probabilities, a piece of rank r
weighs (r + 2.7) ** -theta (Zipf and Mandelbrot).

Sampling is a best-first (A*) search over perturbed log-probabilities, top down (Kool, van Hoof
and Welling 2019): a set of paths has a Gumbel variable at its log-probability, known exactly
from the lattice's backward sums; what is below a set has its maximum, and the other parts are
Gumbels truncated there. The best path below a set therefore is an ordinary draw, node by node,
and every node on it leaves one set of other paths with a bound of its own; the next sample starts
from the set with the largest bound. The first `k` so found are the k largest of independently
perturbed paths, a sample without replacement. With the bound of the best set left as threshold t,
a path of log-probability p is in such a sample with probability 1 - exp(-exp(p - t)); its
logarithm is the inclusion score.

Pieces cross no pair of characters that no piece has inside it, so a text splits into short units
for which tables of nodes and edges are kept per worker (up to CACHE_UNITS). Draws of all units of
a block of texts are made together. Random numbers are hashes of the row's key, the sample and the
place, so that they depend neither on the partition nor on the order of rows.

Edge cases: null and empty texts have one segmentation, of no piece; texts with fewer than k
segmentations give as many as there are; rows of the same key and text get the same samples; a
null key is a key; an empty table gives an empty result; U+2581 in a text is written in bytes, so
that decoding gives back every text exactly; texts are processed whole, whatever their length.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

CACHE_UNITS = 350_000
#: Words remembered per unit of that limit.
WORDS_PER_UNIT = 1.5
#: Units up to this length get their tables together; the weights of all their ways fit a double.
TOGETHER = 48
#: Nodes at the front of a path that get bounds of their own; what lies behind them is one set.
FRONT = 64
#: Texts are processed in blocks of about so many characters.
BLOCK_CHARS = 2_000_000
#: Resolution of a draw.
STEPS = 2.0**28
MOST_NODES = 6_000_000
SPACE = "▁"
_WORDS = re.compile(r" *[^ \n▁]+| +|\n|▁")
_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _place_hash(key: np.ndarray, sample: int, place) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(np.asarray(key, np.uint64) + np.asarray(place, np.uint64) * _U64(0x9E3779B97F4A7C15) + _U64((sample + 1) * 0x2545F4914F6CDD1D & (2**64 - 1)))


def _step_hash(base: np.ndarray, step) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(base + (np.asarray(step, np.uint64) + _U64(1)) * _U64(0xD1B54A32D192ED03))


def uniform(key: np.ndarray, sample: int, place, step) -> np.ndarray:
    """Numbers in (0, 1) that are a function of their arguments."""
    h = _step_hash(_place_hash(key, sample, place), step)
    return ((h >> _U64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattices:
    """The vocabulary, and the tables of the units met so far.

    Edges of a node stand together, nodes in the order of their edges; `upto` holds, for each edge,
    the node's probability up to and with the edge in steps of 2**-28, so that a draw is the first
    edge whose value is above it.
    """

    def __init__(self, path: str, theta: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = {}
        self.weight: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.weight[piece] = i, -theta * math.log(min(-sp.get_score(i), float(n)) + 2.7)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self._trie()
        #: Every beginning of a piece: (its id, its weight), id -1 where it only begins longer ones.
        self.begins: dict[str, tuple[int, float]] = {p[:k]: (-1, 0.0) for p in self.weight for k in range(1, len(p))}
        self.begins |= {p: (i, math.exp(w)) for p, (i, w) in self.weight.items()}
        inside = {p[i : i + 2] for p in self.weight for i in range(len(p) - 1)}
        if any("\n" in p for p in self.weight) or any(p[0] != SPACE and p[1] == SPACE for p in inside):
            raise ValueError("pieces that cross words or lines need units of whole texts")
        step, code = self.trie_step, lambda c: int(self.letter[ord(c)])
        #: Pairs of characters that some piece has inside it.
        self.pair_key = np.array(sorted(code(p[0]) * step + code(p[1]) for p in inside) + [np.iinfo(np.int64).max])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.flat_len = np.array([len(b) for b in self.bytes_of])
        self.flat_at = np.concatenate(([0], np.cumsum(self.flat_len)[:-1]))
        self.clear()

    def _trie(self) -> None:
        """The pieces as a trie in arrays: a hash table of its edges by (node, character), and each node's piece."""
        letters = sorted({c for p in self.weight for c in p})
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        nodes, edges = {"": 0}, []
        for p in self.weight:
            for k in range(1, len(p) + 1):
                if p[:k] not in nodes:
                    nodes[p[:k]] = len(nodes)
                    edges.append((nodes[p[: k - 1]] * (len(letters) + 1) + int(self.letter[ord(p[k - 1])]), nodes[p[:k]]))
        self.trie_step = len(letters) + 1
        bits = (4 * len(edges)).bit_length()
        self.trie_shift = _U64(64 - bits)
        self.trie_key, self.trie_node = np.full((1 << bits) + 64, -1), np.zeros((1 << bits) + 64, np.int64)
        for key, node in edges:
            slot = int(self._slot(np.array([key]))[0])
            while self.trie_key[slot] >= 0:
                slot += 1
            self.trie_key[slot], self.trie_node[slot] = key, node
        self.trie_piece, self.trie_weight = np.full(len(nodes), -1), np.zeros(len(nodes))
        for p, (i, w) in self.weight.items():
            self.trie_piece[nodes[p]], self.trie_weight[nodes[p]] = i, math.exp(w)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * _U64(0x9E3779B97F4A7C15)) >> self.trie_shift).astype(np.int64)

    def _child(self, key: np.ndarray) -> np.ndarray:
        """The trie's node by (node, character), -1 where there is none."""
        slot = self._slot(key)
        there = self.trie_key.take(slot)
        some = np.flatnonzero((there != key) & (there >= 0))
        while len(some):
            slot[some] += 1
            there = self.trie_key[slot[some]]
            some = some[(there != key[some]) & (there >= 0)]
        return np.where(self.trie_key.take(slot) == key, self.trie_node.take(slot), -1)

    def clear(self) -> None:
        #: Numbers in the order of first use; what has a number and no tables yet gets them before the next use.
        self.words: dict[str | tuple[str], int] = defaultdict(count().__next__)
        self.word_at, self.word_units = array("i", [0]), array("i")  # the units of each word
        self.units: dict[str, int] = defaultdict(count().__next__)
        self.start = array("i")  # the first node of each unit
        self.first = array("i", [0])  # the first edge of each node, and the end
        #: Per edge: piece, node after it (-1: the unit ends), log-probability and place.
        self.piece, self.next, self.logq, self.upto = array("H"), array("i"), array("f"), array("I")
        self.share = array("d")  # weights of the edges that have no log-probability yet

    def units_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts, with the space that stands before each, and how many each text has; empty texts have none."""
        words = [self._words(text) for text in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        known = len(self.words)
        ids = np.fromiter(map(self.words.__getitem__, chain.from_iterable(words)), np.int64, int(n_words.sum()))
        if len(self.words) > known:
            self._learn(list(islice(self.words, known, None)))
        # The words' units, one word after the other.
        at = np.frombuffer(self.word_at, np.int32)
        begin = at.take(ids)
        size = at.take(ids + 1) - begin
        ends = np.cumsum(size, dtype=np.int64)
        units = np.frombuffer(self.word_units, np.int32).take(np.repeat(begin - ends + size, size) + np.arange(ends[-1])) if len(ids) else np.zeros(0, np.int32)
        upto = np.concatenate(([0], ends))
        cuts = np.concatenate(([0], np.cumsum(n_words)))
        return units, np.diff(upto[cuts])

    @staticmethod
    def _words(text: str) -> list:
        """What stands between single spaces, each with the space before it left out; where there are other
        spaces or a U+2581, the parts with all their spaces, in a tuple."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return [(w,) for w in _WORDS.findall(" " + text)]
        return text.split(" ")

    def _learn(self, words: list) -> None:
        """Splits new words, in the order of their numbers, where no piece crosses and gives their units tables."""
        literal = (SPACE,)
        at = words.index(literal) if literal in words else None
        plain = [w[0] if w.__class__ is tuple else " " + w for w in words if w != literal]
        text = "".join(plain).replace(" ", SPACE)
        size = np.fromiter(map(len, plain), np.int64, len(plain))
        c = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)
        key = c[:-1] * self.trie_step + c[1:]
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = self.pair_key[np.searchsorted(self.pair_key, key)] != key
        cut[np.cumsum(size)] = True
        places = np.flatnonzero(cut)
        cuts, known = places.tolist(), len(self.units)
        units = np.fromiter(map(self.units.__getitem__, map(text.__getitem__, map(slice, cuts, islice(cuts, 1, None)))), np.int32, len(cuts) - 1)
        n_units = np.add.reduceat(cut[:-1], np.cumsum(size) - size, dtype=np.int64) if len(plain) else size
        self._build(list(islice(self.units, known, None)))
        if at is not None:
            units = np.insert(units, int(n_units[:at].sum()), self._literal())
            n_units = np.insert(n_units, at, 1)
            self._finish()
        self.word_units.frombytes(units.astype(np.int32).tobytes())
        self.word_at.frombytes((np.cumsum(n_units) + self.word_at[-1]).astype(np.int32).tobytes())

    def _build(self, units: list[str]) -> None:
        """Tables of new units: together where their characters are in the vocabulary, else one by one."""
        letter, own = self.letter, self.weight.keys()
        fit = [len(u) <= TOGETHER and own >= set(u) for u in units]
        together = [u for u, f in zip(units, fit) if f]
        starts_of = np.empty(len(units), np.int32)
        fit = np.array(fit, bool)
        for i in np.flatnonzero(~fit).tolist():
            starts_of[i] = self._unit(units[i])
        self._finish()
        if together:
            starts_of[fit] = self._together(together, letter)
        self.start.frombytes(starts_of.tobytes())

    def _together(self, together: list[str], letter: np.ndarray) -> np.ndarray:
        """Tables of units whose characters are in the vocabulary; returns the first node of each."""
        size = np.array([len(u) for u in together])
        chars = letter[np.frombuffer("".join(together).encode("utf-32-le"), np.uint32)].astype(np.int64)
        end = np.repeat(np.cumsum(size), size)  # of its unit, for each position
        position = np.arange(len(chars))
        # Pieces from every position: all positions go down the trie together.
        live, node, depth, found = position, np.zeros(len(chars), np.int64), 0, []
        while len(live):
            node = self._child(node * self.trie_step + chars.take(live + depth))
            ok = node >= 0
            live, node, depth = live[ok], node[ok], depth + 1
            piece = self.trie_piece[node]
            some = piece >= 0
            found.append((live[some], depth, piece[some], self.trie_weight[node[some]]))
            on = live + depth < end[live]
            live, node = live[on], node[on]
        # Nodes by their distance from the unit's end, so that each depends on nodes before it.
        left = end - position
        order = np.argsort(left, kind="stable")
        number = np.empty(len(chars), np.int64)
        number[order] = position
        count = np.zeros(len(chars), np.int64)
        for at, _, _, _ in found:
            count[number[at]] += 1
        first = np.concatenate(([0], np.cumsum(count)))
        piece, after, weight, filled = np.empty(first[-1], np.uint16), np.empty(first[-1], np.int64), np.empty(first[-1]), first[:-1].copy()
        number = np.append(number, -1)
        for at, depth, ids, w in found:
            own = number[at]
            slot = filled[own]
            filled[own] += 1
            piece[slot], weight[slot] = ids, w
            after[slot] = np.where(at + depth < end[at], number[np.minimum(at + depth, len(chars))], -1)
        back = np.ones(len(chars) + 1)  # the last is the end of a unit
        groups = np.concatenate(([0], np.cumsum(np.bincount(left)[1:])))
        for a, b in zip(groups, groups[1:]):
            if a < b:
                weight[first[a] : first[b]] *= back[after[first[a] : first[b]]]
                back[a:b] = np.add.reduceat(weight[first[a] : first[b]], first[a:b] - first[a])
        node, base = len(self.first) - 1, len(self.piece)
        self.piece.frombytes(piece.tobytes())
        self.next.frombytes(np.where(after >= 0, after + node, -1).astype(np.int32).tobytes())
        self.share.frombytes(weight.tobytes())
        self.first.frombytes((first[1:] + base).astype(np.int32).tobytes())
        self._finish()
        return number[np.cumsum(size) - size] + node

    def _literal(self) -> int:
        """The unit of a U+2581 in a text, which is not a space."""
        if "" not in self.units:
            self.start.append(self._chain(SPACE.encode(), -1))
        return self.units[""]

    def _unit(self, unit: str) -> int:
        """The table of one unit; returns its first node."""
        get, n = self.begins.get, len(unit)
        back = [1.0] * (n + 1)  # summed weights of all ways from here to the end, up to the factor of `scale`
        scale = [0] * (n + 1)  # powers of 2**512 taken out, so that long units do not vanish
        node = [-1] * (n + 1)
        first, add_piece, add_next, add_share = self.first, self.piece.append, self.next.append, self.share.append
        for i in range(n - 1, -1, -1):
            total, base = 0.0, scale[i + 1]
            for j in range(i + 1, n + 1):
                own = get(unit[i:j])
                if own is None:
                    break
                if own[0] >= 0:
                    p = own[1] * back[j]
                    if scale[j] != base:
                        p *= 2.0 ** (512 * (scale[j] - base))
                    total += p
                    add_piece(own[0])
                    add_next(node[j])
                    add_share(p)
            if unit[i] not in self.weight:
                # A character outside the vocabulary: its bytes one after the other.
                node[i], back[i], scale[i] = self._chain(unit[i].encode("utf-8", "replace"), node[i + 1]), back[i + 1], base
                continue
            if total < 1e-150:
                total, base = total * 2.0**512, base - 1
            back[i], scale[i] = total, base
            node[i] = len(first) - 1
            first.append(len(self.piece))
        return node[0]

    def _chain(self, data: bytes, following: int) -> int:
        for b in reversed(data):
            self.piece.append(self.byte_id[b]), self.next.append(following), self.share.append(1.0)
            following = len(self.first) - 1
            self.first.append(len(self.piece))
        return following

    def _finish(self) -> None:
        """Log-probabilities and cumulative places of the edges that have none yet."""
        if not self.share:
            return
        done = len(self.logq)
        first = np.frombuffer(self.first, np.int32)
        node = int(np.searchsorted(first, np.int32(done)))
        at, n = first[node:-1].astype(np.int64) - done, np.diff(first[node:])
        del first
        share = np.array(self.share)
        q = share / np.repeat(np.add.reduceat(share, at), n)
        run = np.cumsum(q)
        upto = np.floor(np.minimum(run - np.repeat(run[at] - q[at], n), 1.0) * STEPS).astype(np.uint32)
        upto[at + n - 1] = int(STEPS)
        self.logq.frombytes(np.where(np.repeat(n, n) == 1, 0.0, np.log(q)).astype(np.float32).tobytes())
        self.upto.frombytes(upto.tobytes())
        del self.share[:]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of pieces, the space before the text included."""
        return self.decode_all([ids])[0]

    def decode_all(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each row of pieces, all decoded together."""
        ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        size = self.flat_len.take(ids)
        ends = np.concatenate(([0], np.cumsum(size)))
        flat = self.flat.take(np.repeat(self.flat_at.take(ids) - ends[:-1], size) + np.arange(ends[-1])).tobytes()
        cuts = ends[np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def tables(self) -> Tables:
        """Views of the tables, which cannot grow while these are held."""
        kinds = {"i": np.int32, "H": np.uint16, "f": np.float32, "I": np.uint32}
        return Tables(*(np.frombuffer(x, kinds[x.typecode]) for x in (self.start, self.first, self.piece, self.next, self.logq, self.upto)))


@dataclass
class Tables:
    start: np.ndarray
    first: np.ndarray
    piece: np.ndarray
    next: np.ndarray
    logq: np.ndarray
    upto: np.ndarray

    def draw(self, node: np.ndarray, key: np.ndarray, place: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """From each node to the end of its unit: how many edges, and all edges in order."""
        n = np.zeros(len(node), np.int64)
        live = np.flatnonzero(node >= 0)
        live = live[np.argsort(node[live])]  # neighbours in the tables one after the other
        base = _place_hash(key[live], sample, place[live])
        at, step, steps = node[live].astype(np.int64), 0, []
        while len(live):
            edge = self.first.take(at).astype(np.int64)
            some = np.flatnonzero(self.first.take(at + 1) - edge > 1)  # the others have nothing to draw
            aim = (_step_hash(base.take(some), step) >> _U64(36)).astype(np.uint32)
            here = edge.take(some)
            while len(some):
                on = np.flatnonzero(self.upto.take(here) <= aim)
                some, aim, here = some.take(on), aim.take(on), here.take(on) + 1
                edge[some] = here
            steps.append((live, edge))
            at = self.next.take(edge)
            on = np.flatnonzero(at >= 0)
            n[live] += 1
            live, at, base, step = live.take(on), at.take(on).astype(np.int64), base.take(on), step + 1
        ends = np.cumsum(n)
        out = np.empty(ends[-1] if len(ends) else 0, np.int32)
        begin = ends - n
        for k, (occ, edge) in enumerate(steps):
            out[begin.take(occ) + k] = edge
        return n, out


@dataclass
class Sample:
    edges: np.ndarray
    place: np.ndarray  # the unit of each edge
    logp: float
    value: float  # the perturbed log-probability
    log_inclusion: float = 0.0


def _truncated(mu, most: float, u):
    """Gumbels of location mu, truncated at `most`."""
    with np.errstate(over="ignore", divide="ignore"):
        return mu - np.log(np.exp(mu - most) - np.log(u))


class _Search:
    """The open sets of one text: (bound, node's place on its path, log-probability before it, edges taken there, path).

    Edges are None for the rear of a path: all that leaves it at that place or behind.
    """

    def __init__(self, lattices: Lattices, tables: Tables, key: np.uint64, k: int):
        self.lattices, self.t, self.key, self.k = lattices, tables, key, k
        self.open: list[tuple] = []
        self.calls = 0

    def _u(self, n: int) -> np.ndarray:
        self.calls += 1
        return uniform(np.full(n, self.key), 1 << 20, np.arange(n), self.calls)

    def add(self, sets: list[tuple]) -> None:
        self.open += sets
        self.open.sort(key=lambda x: -x[0])
        del self.open[self.k + 1 :]

    def _enter_rear(self, value: float, i: int, before: float, path: Sample) -> tuple[int, float, tuple[int, ...]]:
        """The bound of a rear is that of one of its nodes, by mass; the others lie below."""
        q = self.t.logq[path.edges[i:]].astype(np.float64)
        upto = before + np.concatenate(([0.0], np.cumsum(q)[:-1]))
        with np.errstate(divide="ignore"):
            mu = upto + np.log(-np.expm1(q))
        mass = np.exp(mu - mu.max())
        j = min(int(np.searchsorted(np.cumsum(mass) / mass.sum(), self._u(1)[0])), len(mass) - 1)
        bound = _truncated(mu, value, self._u(len(q)))
        self.open += [(float(bound[x]), i + x, float(upto[x]), (int(path.edges[i + x]),), path) for x in np.flatnonzero(np.isfinite(mu)).tolist() if x != j]
        return i + j, float(upto[j]), (int(path.edges[i + j]),)

    def next(self) -> tuple[Sample, int, int, float, float] | None:
        """(path to leave, place to leave it, edge to take, log-probability with it, perturbed value) of the best open set."""
        if not self.open:
            return None
        value, i, before, taken, path = self.open.pop(0)
        if taken is None:
            i, before, taken = self._enter_rear(value, i, before, path)
        first = self.lattices.first
        node = bisect_right(first, taken[0]) - 1
        edges = [e for e in range(first[node], first[node + 1]) if e not in taken]
        logq = self.lattices.logq
        p = [math.exp(logq[e]) for e in edges]
        total = sum(p)
        u = self._u(2)
        left, j = float(u[0]) * total, 0
        while j < len(p) - 1 and left >= p[j]:
            left -= p[j]
            j += 1
        if len(edges) > 1:
            rest = math.log(max(math.fsum(p[:j] + p[j + 1 :]), 1e-300))
            self.add([(float(_truncated(before + rest, value, u[1])), i, before, (*taken, edges[j]), path)])
        return path, i, edges[j], before + logq[edges[j]], value


def _left_aside(tables: Tables, keys: np.ndarray, paths: list[Sample], ats: list[int], befores: list[float], sample: int, k: int) -> list[list[tuple]]:
    """For each path, the sets that it leaves aside from its place `at` on: the best k + 1 at nodes, and its rear."""
    n = np.array([len(p.edges) for p in paths])
    at, before, value = np.array(ats), np.array(befores), np.array([p.value for p in paths])
    front = np.minimum(n - at, FRONT)
    width = int(front.max()) if len(front) else 0
    out: list[list[tuple]] = [[] for _ in paths]
    if width <= 0:
        return out
    mask = np.arange(width) < front[:, None]
    edges = np.zeros((len(paths), width), np.int32)
    edges[mask] = np.concatenate([p.edges[a : a + f] for p, a, f in zip(paths, ats, front.tolist())])
    q = np.where(mask, tables.logq[edges], 0.0).astype(np.float64)
    upto = before[:, None] + np.cumsum(q, axis=1)
    behind = upto[:, -1]
    upto = np.concatenate((before[:, None], upto[:, :-1]), axis=1)
    u = uniform(np.repeat(keys, width), 1 << 22, np.tile(np.arange(width), len(paths)), sample).reshape(len(paths), width)
    with np.errstate(divide="ignore"):
        mu = upto + np.log(-np.expm1(q))  # minus infinity where the node has one edge, or none
        bound = np.where(np.isfinite(mu), _truncated(mu, value[:, None], u), -np.inf)
    best = np.argsort(-bound, axis=1)[:, : k + 1]
    rows = np.arange(len(paths))[:, None]
    for own, path, a, places, bounds, sums, taken in zip(out, paths, ats, best.tolist(), bound[rows, best].tolist(), upto[rows, best].tolist(), edges[rows, best].tolist()):
        own += [(b, a + x, s, (e,), path) for x, b, s, e in zip(places, bounds, sums, taken) if b > -math.inf]
    rest = np.array([p.logp for p in paths]) - behind
    some = np.flatnonzero((at + front < n) & (rest < 0))
    mass = behind[some] + np.log(-np.expm1(rest[some]))
    bounds = _truncated(mass, value[some], uniform(keys[some], 1 << 23, 0, sample))
    for d, b in zip(some.tolist(), bounds.tolist()):
        out[d].append((b, int(at[d] + front[d]), float(behind[d]), None, paths[d]))
    return out


def sample_block(lattices: Lattices, texts: list[str], keys: np.ndarray, k: int) -> tuple[Tables, list[list[Sample]]]:
    """Up to k segmentations of each text, in the order of their perturbed values; `keys`: uint64 per text."""
    units, sizes = lattices.units_of(texts)
    tables = lattices.tables()
    start = tables.start[units]
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(len(units)) - np.repeat(cuts[:-1], sizes)
    lead = -np.log(-np.log(uniform(keys, 1 << 21, 0, 0)))
    n, edges = tables.draw(start, np.repeat(keys, sizes), place, 0)
    ends = np.concatenate(([0], np.cumsum(n)))[cuts]
    of_edge = np.repeat(place, n)
    samples: list[list[Sample]] = []
    searches = []
    logp = np.add.reduceat(np.append(tables.logq[edges].astype(np.float64), 0.0), ends[:-1]) * (ends[1:] > ends[:-1])
    for a, b, key, value, p in zip(ends.tolist(), ends[1:].tolist(), keys, lead.tolist(), logp.tolist()):
        samples.append([Sample(edges[a:b], of_edge[a:b], p, value)])
        searches.append(_Search(lattices, tables, key, k))
    for search, sets in zip(searches, _left_aside(tables, keys, [s[0] for s in samples], [0] * len(texts), [0.0] * len(texts), 0, k)):
        search.add(sets)
    for r in range(1, k):
        todo = [(d, way) for d, s in enumerate(searches) if (way := s.next()) is not None]
        nodes, places = [], []
        for d, (path, i, edge, _, _) in todo:
            at = int(path.place[i])
            nodes.append(np.concatenate(([tables.next[edge]], start[cuts[d] + at + 1 : cuts[d + 1]])))
            places.append(np.arange(at, sizes[d]))
        if not todo:
            break
        n, edges = tables.draw(np.concatenate(nodes), np.repeat(keys[[d for d, _ in todo]], [len(x) for x in nodes]), np.concatenate(places), r)
        ends, a, fresh = np.concatenate(([0], np.cumsum(n))), 0, []
        for (d, (path, i, edge, with_edge, value)), place in zip(todo, places):
            b = a + len(place)
            rest = edges[ends[a] : ends[b]]
            own = np.concatenate((path.edges[:i], np.array([edge], np.int32), rest))
            where = np.concatenate((path.place[: i + 1], np.repeat(place, n[a:b])))
            new = Sample(own, where, with_edge + float(tables.logq[rest].sum(dtype=np.float64)), value)
            samples[d].append(new)
            fresh.append(new)
            a = b
        places = [i + 1 for _, (_, i, _, _, _) in todo]
        aside = _left_aside(tables, keys[[d for d, _ in todo]], fresh, places, [x for _, (_, _, _, x, _) in todo], r, k)
        for (d, _), sets in zip(todo, aside):
            searches[d].add(sets)
    for own, search in zip(samples, searches):
        if search.open:
            for s in own:
                x = s.logp - search.open[0][0]
                s.log_inclusion = x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 50.0))))
    return tables, samples


_loaded: dict[tuple[str, float], Lattices] = {}


def _trim() -> None:
    """Gives freed memory back to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, theta: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, cache_units: int = CACHE_UNITS, block_chars: int = BLOCK_CHARS, release: bool = False) -> DataFrame:
    """Per row of `docs` and sample: the id, sample (from 1), n_pieces, log_prob, perturbed, log_inclusion,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers), decoded (whether the pieces give
    back the text exactly) and, if asked for, ids. `cache_units` and `block_chars` bound a worker's
    memory (about 1 kB a unit, 50 bytes a character); with `release` a task leaves its tables to no
    later task of its worker. None of them changes a result."""

    def blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        names, texts, held = [], [], 0
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            names.append(name)
            texts.append(text.as_py())
            held += len(texts[-1])
            if held >= block_chars:
                yield names, texts
                names, texts, held = [], [], 0
        if names:
            yield names, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        if (model, theta) not in _loaded:
            _loaded[model, theta] = Lattices(model, theta)
        lattices = _loaded[model, theta]
        for batch in batches:
            for names, texts in blocks(batch):
                if len(lattices.units) > cache_units or len(lattices.words) > WORDS_PER_UNIT * cache_units or len(lattices.first) > MOST_NODES:
                    lattices.clear()
                keys = np.array([xxh64_intdigest(str(x), seed) for x in names], np.uint64)
                tables, samples = sample_block(lattices, texts, keys, k)
                rows = [(name, text, r, s, tables.piece.take(s.edges)) for name, text, own in zip(names, texts, samples) for r, s in enumerate(own)]
                pieces = [x[4] for x in rows]
                of_rows = np.concatenate(([0], np.cumsum([len(x) for x in pieces], dtype=np.int64)))
                flat = (np.concatenate(pieces) if pieces else np.zeros(0)).astype("<u4")
                cuts = of_rows.tolist()
                back = lattices.decode_all(pieces)
                out = {
                    id_col: pa.array([x[0] for x in rows], pa.int64()),
                    "sample": pa.array([x[2] + 1 for x in rows], pa.int32()),
                    "n_pieces": pa.array(np.diff(of_rows), pa.int64()),
                    "log_prob": pa.array([x[3].logp for x in rows], pa.float64()),
                    "perturbed": pa.array([x[3].value for x in rows], pa.float64()),
                    "log_inclusion": pa.array([x[3].log_inclusion for x in rows], pa.float64()),
                    "ids_crc32": pa.array([zlib.crc32(flat[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    "decoded": pa.array([b[1:] == x[1].encode("utf-8", "replace") for b, x in zip(back, rows)], pa.bool_()),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(pa.array(of_rows, pa.int32()), pa.array(flat.view(np.int32), pa.int32()))
                del tables, samples, rows, pieces, back
                yield pa.RecordBatch.from_pydict(out)
        if release:
            _loaded.clear()
            lattices = None
            _trim()

    schema = f"`{id_col}` long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, decoded boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)
