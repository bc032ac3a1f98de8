"""Main text of web pages by equivalence-class template deduction.

A page is a stream of tokens in its own order: start and end tags and text nodes, each told apart
by the path of containers it stands in. The occurrence vector of a token says how often it stands on each page
of its host; tokens of a host with equal vectors form an equivalence class. A vector is never
built: its product with random numbers drawn per page adds up over any partition of the pages,
and tokens with equal sums, page and occurrence counts have equal vectors. A class is used if it
is frequent (on at least `support` of the host's pages) and valid: its tokens come in one order on
every page, which a second pass over the pages finds out (tokens out of order on some page are
split off), each start tag has its end tag in the class, and a text stands in an element that has
both. An element that another one's end tag closes has no end. The valid classes nest by path into
the template of the host.

The template's slots, what stands between its tokens, are weighed by the text that all pages of
the host have in them. Slots inside menus, headers, footers, sidebars, notices, adverts, forms and
reader comments (by element, role, class or id) do not count. The article is the innermost
container once per page that holds at least `mass` of what is left; on each page its slots are
then read out, without the text nodes that are template tokens. Only where these hold more than
1 - `mass` of the text of an element of that meaning (article, main), its pages are copies of one
article, and the text in it stays. Which containers a page has is not bounded by their depth: below
LISTED of them a path goes on as a chain of hashes. A text has to stand on `least_pages` pages to be a token of it. A host with too few pages for a template
takes the one of all pages together.

Sums per host and token are pre-aggregated by task. Templates of hosts with over 1/HOT_HOSTS of all
pages, at most HOT_HOSTS of them, go to the pages by broadcast, the others by a join on the host.

Edge cases: a null html is empty and gives an empty text; a null url belongs to the host ""; an
unclosed element ends where its parent or the page does; a tag that the page breaks off in is
dropped; repeated ids are separate pages; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_join, materialise

HOT_HOSTS = 2000
#: Paths list so many containers; those below are named by a hash that chains them, so that a path's length is bounded at any depth.
LISTED = 200

# What the elements mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
OPAQUE = frozenset("script style noscript template svg iframe object textarea select button canvas head math audio video map".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
#: Paragraph-like elements, which hold no container and end with any other block.
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 pre dt dd figcaption caption".split())
MAIN = frozenset("article main".split())
#: Words of a class, id or role that tell what is not the article.
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo(?:tion)?|banner|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|widget|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"comments?|replies|disqus|respond|related|recommended|share|sharing|social|newsletter|subscribe|subscription|login|signup|search|complementary|contentinfo|masthead|topbar|toolbar|pager|pagination)(?:$|[\s_-])"
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = {name: re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "title", "iframe", "noscript")}


def _label(name: str, attributes: str) -> tuple[str, bool]:
    """The element with its class, id and role; whether these tell that it is not the article."""
    if not attributes:
        return name, False
    names = " ".join("".join(m) for m in _NAMES.findall(attributes)).lower()
    return (f"{name}.{'.'.join(names.split())}" if names else name), bool(names and _NOISE.search(names))


def nodes(page: str) -> Iterator[tuple[str, str, bool, str, bool]]:
    """(kind, path, whether it is noise, text, whether a new block starts), in the order of the page.

    The kind is "<" at a container's start, "</" at its end, "<>" where it ends without an end of its
    own (which is no token), and "t" at a text node. Ends are those that the page has, and its own
    end for what is still open there.
    """
    stack: list[tuple[str, str, bool]] = [("", "", False)]  # element, path, noise
    opened: Counter[str] = Counter()
    at, block, aside = 0, True, False  # aside: in a paragraph whose names tell that it is not the article
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not text.isspace():
            yield "t", stack[-1][1], stack[-1][2] or aside, text, block
            block = False
        elif text and not block:
            yield "t", stack[-1][1], stack[-1][2] or aside, " ", False
        if not m:
            for _, path, noise in stack[:0:-1]:
                yield "</", path, noise, "", True
            return
        at = m.end()
        end, name, attributes, closed = m.groups()
        if name is None or closed != ">":
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br" and not block:
                yield "t", stack[-1][1], stack[-1][2] or aside, " ", False
            continue
        block = True
        if name in _RAW and not end:
            close = _RAW[name].search(page, at)
            at = close.end() if close else len(page)
            continue
        if name in VOID:
            aside = aside and name != "hr"
            continue
        aside = name in LEAF and not end and _label(name, attributes)[1]
        if name in LEAF:
            continue
        if end:
            # The innermost open element of that name ends, and all within it, which has no end of its own; a stray end tag does nothing.
            while opened[name]:
                inner, path, noise = stack.pop()
                opened[inner] -= 1
                if inner == name:
                    yield "</", path, noise, "", True
                    break
                yield "<>", path, noise, "", True
        else:
            label, noise = _label(name, attributes)
            _, path, within = stack[-1]
            noise = within or noise or name in OPAQUE or name in ASIDE or (name == "header" and not any(opened[x] for x in MAIN))
            stack.append((name, f"{path}>{label}" if len(stack) < LISTED else _below(path, label), noise))
            opened[name] += 1
            yield "<", stack[-1][1], noise, "", True


def _below(path: str, label: str) -> str:
    """The path of a container in one that is as deep as paths list: the listed part, the parent's hash, its own and its element."""
    from xxhash import xxh64_hexdigest

    top, _, deep = path.partition(">#")
    parent = deep.split(".", 2)[1] if deep else ""
    own = xxh64_hexdigest(f"{path}>{label}".encode("utf-8", "surrogatepass"))
    return f"{top}>#{parent}.{own}.{label.partition('.')[0]}"


def _up(path: str) -> tuple[str, str] | None:
    """(parent's hash, own hash) of a container below the listed depth."""
    deep = path.partition(">#")[2]
    return tuple(deep.split(".", 2)[:2]) if deep else None


def _token(kind: str, path: str, text: str) -> str:
    """The token of a node: a tag with its path, or a text's hash with the path it stands in."""
    from xxhash import xxh64_hexdigest

    return kind + path if kind != "t" else f"t{xxh64_hexdigest(' '.join(text.split()).encode('utf-8', 'surrogatepass'))}{path}"


def _place(token: str) -> str:
    """The path in which a text token stands."""
    return token[17:]


def tokens(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(host, token, n_pages, n_occ, vector, mass, at): sums over the pages of each host; `at` of the places in the stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        sums: dict[tuple[str, str], list[int]] = {}

        def out() -> pa.RecordBatch:
            keys, values = list(sums), list(sums.values())
            names = ("n_pages", "n_occ", "vector", "mass", "at")
            columns = {"host": pa.array([k[0] for k in keys], pa.string()), "token": pa.array([k[1] for k in keys], pa.string())}
            columns |= {n: pa.array([v[i] if n != "vector" else str(v[i]) for v in values], pa.string() if n == "vector" else pa.int64()) for i, n in enumerate(names)}
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for where, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = page.as_py()
                drawn = xxh64_intdigest(page.encode("utf-8", "surrogatepass"))
                seen: dict[str, list[int]] = {"": [1, 0, 0]}
                for i, (kind, path, noise, text, _) in enumerate(nodes(page)):
                    if text == " " or kind == "<>":
                        continue
                    own = seen.setdefault(_token(kind, path, text), [0, 0, 0])
                    own[0] += 1
                    own[2] += i
                    if kind == "t" and not noise:
                        own[1] += len(text)
                        seen.setdefault(f"<{path}", [0, 0, 0])[1] += len(text)
                for token, (n, mass, at) in seen.items():
                    s = sums.setdefault((where, token), [0, 0, 0, 0, 0])
                    s[0] += n > 0
                    s[1] += n
                    s[2] += n * drawn
                    s[3] += mass
                    s[4] += at
            if len(sums) > 200_000:
                yield out()
                sums.clear()
        yield out()

    schema = "host string, token string, n_pages long, n_occ long, vector string, mass long, at long"
    parts = pages.select(host, html).mapInArrow(run, schema)
    # Sums of up to 2^63 pages' numbers below 2^64 fit a decimal of 38 digits.
    return parts.groupBy("host", "token").agg(F.sum("n_pages").alias("n_pages"), F.sum("n_occ").alias("n_occ"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"), F.sum("mass").alias("mass"), F.sum("at").alias("at"))


def templates(counts: DataFrame, support: float, least_pages: int) -> DataFrame:
    """(host, pages, template): the frequent tokens of each host with their class, and all pages together as host "*"."""
    everywhere = counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("n_pages", "n_occ", "vector", "mass", "at")]).withColumn("host", F.lit("*"))
    counts = counts.unionByName(everywhere)
    pages = counts.where("token = ''").select("host", F.col("n_pages").alias("pages"))
    # Hosts have tokens about as they have pages; "*" counts every page again.
    total = 2 * (pages.agg(F.max("pages")).first()[0] or 0)
    frequent = hot_join(counts, pages, "host", "pages", total, HOT_HOSTS, 20).where((F.col("n_pages") >= F.col("pages") * support) & ((F.col("pages") >= least_pages) | (F.col("host") == "*")))
    # A passage that a few pages happen to share is no template either.
    frequent = frequent.where(~F.col("token").startswith("t") | (F.col("n_pages") >= least_pages))
    # One class per occurrence vector. A host has at most 1 / support times the tokens of its mean page here.
    classes = frequent.groupBy("host", "pages", "n_pages", "n_occ", "vector").agg(F.sort_array(F.collect_list(F.struct("at", "token", "mass"))).alias("tokens"))
    return classes.groupBy("host", "pages").agg(F.collect_list(F.struct("n_pages", "n_occ", "tokens")).alias("classes"))


def _increasing(keys: list[tuple[int, int]]) -> set[int]:
    """Where a longest strictly increasing subsequence of `keys` stands."""
    ends: list[tuple[int, int]] = []
    last: list[int] = []
    before = []
    for i, key in enumerate(keys):
        k = bisect_left(ends, key)
        ends[k : k + 1], last[k : k + 1] = [key], [i]
        before.append(last[k - 1] if k else -1)
    out, i = set(), last[-1] if last else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def ranks(classes: list) -> dict[str, tuple[int, int]]:
    """(class, place in it) of each token; tokens of a class that keep their order on all pages have it in the sums of their places too."""
    return {t["token"]: (k, r) for k, c in enumerate(classes) for r, t in enumerate(c["tokens"])}


def out_of_order(page: str, rank: dict[str, tuple[int, int]]) -> set[str]:
    """Tokens that break the order of their class on a page: each round of a class's tokens has to come in their order."""
    runs: dict[int, list[tuple[int, int, str]]] = {}
    n: Counter[str] = Counter()
    for kind, path, _, text, _ in nodes(page):
        if text != " " and kind != "<>":
            token = _token(kind, path, text)
            if token in rank:
                k, r = rank[token]
                runs.setdefault(k, []).append((n[token], r, token))
                n[token] += 1
    out: set[str] = set()
    for run in runs.values():
        keys = [x[:2] for x in run]
        if any(a >= b for a, b in zip(keys, keys[1:])):
            kept = _increasing(keys)
            out.update(x[2] for i, x in enumerate(run) if i not in kept)
    return out


def article_of(classes: list, mass: float, disordered: frozenset[str] | set[str] = frozenset()) -> tuple[str, set[str]]:
    """The path of the article in a host's template, and the text tokens of the template.

    Valid are elements whose start and end are of one class, and texts that stand in such an
    element, all without the tokens that are out of order on some page.
    """
    once, nests, weight, held = set(), {""}, {}, {}
    for c in classes:
        names = {t["token"] for t in c["tokens"]} - disordered
        for t in c["tokens"]:
            token = t["token"]
            if token.startswith("t"):
                if token in names:
                    held[token] = t["mass"]
            elif token.startswith("<>"):
                weight[token[1:]] = weight.get(token[1:], 0) + t["mass"]
                if token in names and f"</{token[1:]}" in names:
                    nests.add(token[1:])
                    if c["n_pages"] == c["n_occ"]:
                        once.add(token[1:])
    texts = {t for t in held if _place(t) in nests}
    total = sum(weight.values())
    below = _weights_below(weight, nests | once)
    inside = {p: below[p] if _up(p) else sum(w for q, w in weight.items() if q == p or q.startswith(p + ">")) for p in once}
    good = [p for p in once if total and inside[p] >= mass * total]
    # Innermost; an element that means article or main goes before a deeper one without meaning. Of those below the
    # listed depth, which hold each other, the one with the least in it is innermost.
    best = max(good, key=lambda p: (_means_main(p), p.count(">"), -inside[p] if _up(p) else inside[p], p), default="")
    if _means_main(best):
        # Pages whose articles are mostly the same text are copies of one article, not a template around slots.
        shared = {t for t in texts if _place(t) == best or _place(t).startswith(best + ">") or (_up(best) and _is_below(_place(t), best, nests | set(weight)))}
        if sum(held[t] for t in shared) > (1 - mass) * inside[best]:
            texts -= shared
    return best, texts


def _weights_below(weight: dict[str, int], paths: set[str]) -> dict[str, int]:
    """Of containers below the listed depth, the weight of each with all it holds: sums go up the chain of hashes, the lowest first."""
    deep = {_up(p)[1]: p for p in paths | set(weight) if _up(p)}
    depth: dict[str, int] = {}
    for own in deep:
        chain = []
        while own in deep and own not in depth:
            chain.append(own)
            own = _up(deep[own])[0]
        level = depth.get(own, 0)
        for x in reversed(chain):
            level += 1
            depth[x] = level
    total = {own: weight.get(p, 0) for own, p in deep.items()}
    for own in sorted(deep, key=lambda x: -depth[x]):
        parent = _up(deep[own])[0]
        if parent in total:
            total[parent] += total[own]
    return {p: total[own] for own, p in deep.items()}


def _is_below(path: str, best: str, paths: set[str]) -> bool:
    """Whether a container below the listed depth lies in `best`, which does too."""
    deep = {_up(p)[1]: _up(p)[0] for p in paths if _up(p)}
    up, own = _up(path), _up(best)[1]
    at = up[1] if up else ""
    while at and at != own:
        at = deep.get(at, "")
    return at == own


def _means_main(path: str) -> bool:
    deep = path.partition(">#")[2]
    return (deep.split(".", 2)[2] if deep else path.rpartition(">")[2].split(".")[0]) in MAIN


def main_text(page: str, article: str, template_texts: set[str]) -> str | None:
    """The slots of the article, a line per block; None if the page has no such element."""
    blocks: list[list[str]] = []
    there, fresh, within = not article, True, int(not article)
    for kind, path, noise, text, new in nodes(page):
        if path == article and kind != "t":
            within += 1 if kind == "<" else -1
        if not within:
            continue
        there = True
        fresh |= new
        if noise or kind != "t" or (text != " " and template_texts and _token(kind, path, text) in template_texts):
            continue
        if fresh:
            blocks.append([])
        fresh = False
        blocks[-1].append(text)
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x) if there else None


def with_classes(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """(id, url, host, html) with the further columns of the host's template in `found`, null where it has none."""
    hot = F.col("pages") > max(20, total // HOT_HOSTS)
    own = found.where("host <> '*'")
    columns = ["id", "url", "host", "html", *[c for c in found.columns if c not in ("host", "pages")]]
    first = rows.join(F.broadcast(own.where(hot).drop("pages")), "host", "left").select(*columns)
    if not own.where(~hot).isEmpty():
        cold = first.where("classes is null").select(*columns[:4]).join(own.where(~hot).drop("pages"), "host", "left")
        first = first.where("classes is not null").unionByName(cold.select(*columns))
    return first


def disordered(paired: DataFrame, everywhere: list) -> DataFrame:
    """(host, token) of the template tokens that are out of order on some page, for host "*" in the template of all pages."""
    common = ranks(everywhere)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[str, tuple[int, int]]] = {}
        for batch in batches:
            out: set[tuple[str, str]] = set()
            for where, page, classes in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if where not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[where] = ranks(classes.as_py()) if classes.is_valid else {}
                page = page.as_py()
                out.update((where, t) for t in out_of_order(page, known[where]))
                out.update(("*", t) for t in out_of_order(page, common))
            yield pa.RecordBatch.from_pydict({"host": pa.array([x[0] for x in out], pa.string()), "token": pa.array([x[1] for x in out], pa.string())})

    return paired.select("host", "html", "classes").mapInArrow(run, "host string, token string").distinct()


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", support: float = 0.5, mass: float = 0.6, least_pages: int = 4) -> DataFrame:
    """Per row of `pages`: the id, the url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    found = materialise(templates(materialise(tokens(rows, "host", "html")), support, least_pages))
    common = found.where("host = '*'").first()
    total = common["pages"] if common else 0
    paired = with_classes(rows, found, total)
    bad = materialise(disordered(paired, common["classes"] if common else []))
    everywhere = {r["token"] for r in bad.where("host = '*'").select("token").toLocalIterator()}  # of one template
    default = article_of(common["classes"], mass, everywhere) if common else ("", set())
    per_host = bad.where("host <> '*'").groupBy("host").agg(F.collect_set("token").alias("disordered"))
    columns = [*found.columns, "disordered"]
    paired = with_classes(rows, found.join(per_host, "host", "left").select(*columns), total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, set[str]]] = {}
        for batch in batches:
            texts = []
            for where, page, classes, broken in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), batch.column(5)):
                if where not in known:
                    if len(known) > 5000:
                        known.clear()
                    own = article_of(classes.as_py(), mass, set(broken.as_py() or ())) if classes.is_valid else ("", set())
                    known[where] = own if own[0] else (default[0], own[1] or default[1])
                page = page.as_py()
                tries = (known[where], default, ("", default[1]))
                texts.append(next(t for t in (main_text(page, *x) for x in tries) if t is not None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return paired.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` string, text string, n_chars long")
