"""Main text of web pages by union-free wrappers, one per host.

A page is a stream of block tags and text slots. The streams of all pages of a host are folded, a block repeated in a row becoming a
repeated group, and the distinct ones are aligned, ``TOGETHER`` at a time and the results again until one is left: where two differ, what only
one has becomes an optional group. The result is a regular expression without unions over tags and text slots: the host's wrapper. Text in dropped
elements has slots of its own. A slot holds main text if most texts that all pages of the host have there do: those in the article and outside menus,
headers, footers, sidebars, notices, adverts, forms and comments of readers.

Every page of the host is then matched with the wrapper from left to right, and the slots decide what is kept. A page that its host's wrapper does not
match is its own wrapper. Texts are whole: references are decoded, white space inside a block becomes one space, blocks are joined in
page order by two line ends.

Null and empty pages give an empty text. Pages without a host in their address share one wrapper. Very long pages are one stream, matched
in one pass. Repeated rows give repeated results; a table without pages gives none. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.llm.common import add_columns, schema_with, small, stored

# Wrappers of a host that one task aligns, about.
TOGETHER = 16
# Text slots: of text that nothing drops, and of text inside a dropped element.
TEXT, GONE = "#", "#!"
# Lists are compared exactly up to this product of their lengths; longer ones are cut at what both have once.
_EXACT = 1 << 20

# Elements by what they do, and the words by which class, id and role name what is not the article.
RAW = "script style noscript template textarea title iframe svg select option button object canvas"
DROPPED = {*RAW.split(), "head", "nav", "header", "footer", "aside", "form", "menu", "dialog"}
VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "source", "col", "embed", "area", "base", "track", "param"}
INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var br img wbr ruby rt rp picture source".split()
)
ARTICLE = {"article", "main"}
NOT_MAIN = set(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments commentlist respond "
    "disqus widget toolbar pager pagination search complementary contentinfo".split()
)
# Words after the noun that tells what an element is, and words before it that tell what another element has.
AFTER = set(
    "area article articles bar block body box bottom btn button buttons card cards col column container content entry field group heading "
    "icon icons inner item items label layer left link links list main message panel post posts primary right row rows secondary section "
    "slot stories text title top unit widget widgets wrap wrapper".split()
)
HAVING = {"has", "have", "with", "without", "no", "not", "is", "after", "before"}
SITE_HEADER = {"header", "site-header", "page-header", "top-header"}

_TOKEN = re.compile(
    rf"<!--.*?(?:--!?>|\Z)|<({'|'.join(RAW.split())})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-z][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def _marks(tag: str) -> list[str]:
    return [(a or b or c).lower() for a, b, c in _MARKS.findall(tag)]


def _is_dropped(name: str, marks: list[str]) -> bool:
    if name in DROPPED:
        return True
    if name in ("html", "body", "article", "main"):
        return False
    return any(_is_side(w) or w in SITE_HEADER for m in marks for w in m.split())


def _is_side(mark: str) -> bool:
    """Whether a class, id or role names an element that is not the article: by its noun, as ``share-buttons``, not ``search-method`` or ``has-sidebar``."""
    words = [w for w in _WORDS.split(mark) if w]
    if not words or words[0] in HAVING:
        return False
    while words and words[-1] not in NOT_MAIN and (words[-1] in AFTER or words[-1].isdigit()):
        words.pop()
    return bool(words) and words[-1] in NOT_MAIN


def stream(page: str) -> tuple[list[str], list[tuple[str, bool, bool]]]:
    """(symbols, texts): block tags and a text slot for each text block, ``#!`` inside what is dropped; and each block's text, whether
    it is outside all that is dropped, and whether it is in an article."""
    symbols: list[str] = []
    texts: list[tuple[str, bool, bool]] = []
    open_: list[tuple[str, bool, bool]] = []  # name, dropped, in an article
    parts: list[str] = []

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                gone = bool(open_ and open_[-1][1])
                symbols.append(GONE if gone else TEXT)
                texts.append((text, not gone, bool(open_ and open_[-1][2])))

    for token in _TOKEN.finditer(page):
        tag = token[0]
        if tag[0] != "<" or tag == "<":
            parts.append(tag)
            continue
        if token[1] or tag[1] in "!?":
            continue
        found = _NAME.match(tag)
        if not found:
            continue
        name = found[1].lower()
        if tag[1] == "/":
            if name not in INLINE:
                end_block()
                symbols.append("/" + name)
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if at is not None:
                # An inline end tag closes nothing but inline elements.
                if name not in INLINE or all(o[0] in INLINE for o in open_[at:]):
                    if name in INLINE and open_[at][1] != (open_[at - 1][1] if at else False):
                        end_block()
                    del open_[at:]
            continue
        if name == "br":
            parts.append(" ")
            continue
        marks = _marks(tag)
        gone = _is_dropped(name, marks)
        if name not in INLINE or gone:
            end_block()
        if name not in INLINE:
            # A mark with a digit names one element, not its kind; whether it drops the element is kept.
            kinds = sorted(m for m in marks if not any(c.isdigit() for c in m))
            symbols.append(" ".join([name, *kinds, *(["!"] if gone else [])]))
        if name == "p":  # a paragraph ends the one before it
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] not in INLINE), None)
            if at is not None and open_[at][0] == "p":
                del open_[at:]
        if name not in VOID and not tag.endswith("/>"):
            above = open_[-1] if open_ else ("", False, False)
            open_.append((name, above[1] or gone, above[2] or name in ARTICLE))
    end_block()
    return symbols, texts


# A wrapper is a list of nodes: a symbol, ["?", nodes] or ["+", nodes]; a text slot is ["#", number] or ["#!", number] once numbered.


def _plain(nodes: list) -> str:
    return json.dumps(nodes)


def fold(nodes: list, longest: int = 24) -> list:
    """Blocks that stand several times in a row, as one repeated group; shorter blocks first, so groups nest."""
    for size in range(1, longest + 1):
        out: list = []
        at = 0
        while at < len(nodes):
            block = nodes[at : at + size]
            n = 1
            while len(block) == size and nodes[at + n * size : at + (n + 1) * size] == block:
                n += 1
            if n > 1 and block != [TEXT]:
                out.append(["+", block])
                at += n * size
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def _anchors(a: list[str], b: list[str], size: int) -> list[tuple[int, int]]:
    """Places, rising in both lists, of runs of ``size`` that each list has once."""

    def once(x: list[str]) -> dict[tuple[str, ...], int]:
        places: dict[tuple[str, ...], int] = {}
        for i in range(len(x) - size + 1):
            run = tuple(x[i : i + size])
            places[run] = -1 if run in places else i
        return places

    there = once(b)
    pairs = [(i, there[run]) for run, i in once(a).items() if i >= 0 and there.get(run, -1) >= 0]
    # The longest chain that rises in b as well.
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs := sorted(pairs)):
        at = bisect_left(ends, j)
        before.append(last[at - 1] if at else -1)
        ends[at : at + 1], last[at : at + 1] = [j], [n]
    out = []
    n = last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of equal stretches, in order. Long lists take about linear time and may share more than is found."""
    out = []
    waiting = [(0, len(a), 0, len(b))]
    while waiting:
        a0, a1, b0, b1 = waiting.pop()
        if (a1 - a0) * (b1 - b0) <= _EXACT:
            blocks = SequenceMatcher(None, a[a0:a1], b[b0:b1], autojunk=False).get_matching_blocks()
            out += [(a0 + m.a, b0 + m.b, m.size) for m in blocks if m.size]
            continue
        same = next((n for n, (x, y) in enumerate(zip(a[a0:a1], b[b0:b1])) if x != y), min(a1 - a0, b1 - b0))
        if same:
            out.append((a0, b0, same))
            waiting.append((a0 + same, a1, b0 + same, b1))
            continue
        for size in (1, 8, 64):
            anchors = _anchors(a[a0:a1], b[b0:b1], size)
            if anchors:
                break
        at = (a0, b0)
        for i, j in ((a0 + i, b0 + j) for i, j in anchors):
            out.append((i, j, 1))
            waiting.append((at[0], i, at[1], j))
            at = (i + 1, j + 1)
        if anchors:
            waiting.append((at[0], a1, at[1], b1))
    return sorted(out)


def _form(node) -> tuple[list, bool, bool]:
    """What stands within a node, and whether that is optional and repeated."""
    optional = repeated = False
    while not isinstance(node, str):
        optional, repeated = optional or node[0] == "?", repeated or node[0] == "+"
        if len(node[1]) > 1:
            return node[1], optional, repeated
        node = node[1][0]
    return [node], optional, repeated


def align(wrapper: list, page: list) -> list:
    """A wrapper for what either of two is for: common nodes stay, others become optional; a group meets its own single block."""

    def key(node) -> str:
        inner = _form(node)[0]
        return inner[0] if len(inner) == 1 else _plain(inner)

    out: list = []
    a = b = 0
    same = _common([key(n) for n in wrapper], [key(n) for n in page])
    for i, j, n in [*same, (len(wrapper), len(page), 0)]:
        for extra in (wrapper[a:i], page[b:j]):
            if extra:
                out.append(extra[0] if len(extra) == 1 and not isinstance(extra[0], str) and extra[0][0] == "?" else ["?", extra])
        for mine, theirs in zip(wrapper[i : i + n], page[j : j + n]):
            inner, *kinds = _form(mine)
            optional, repeated = (x or y for x, y in zip(kinds, _form(theirs)[1:]))
            inner = [["+", inner]] if repeated else inner
            out.append(["?", inner] if optional else inner[0])
        a, b = i + n, j + n
    return fold(out)


def number(nodes: list, count: list[int]) -> list:
    """Text slots numbered from left to right."""
    out = []
    for node in nodes:
        if node in (TEXT, GONE):
            out.append([node, count[0]])
            count[0] += 1
        else:
            out.append(node if isinstance(node, str) else [node[0], number(node[1], count)])
    return out


def match(nodes: list, symbols: list[str], at: int, slots: list[int]) -> int:
    """Where the nodes end that were matched from ``at`` on, or -1; groups take all they can and give nothing back."""
    for node in nodes:
        if isinstance(node, str):
            if at >= len(symbols) or symbols[at] != node:
                return -1
            at += 1
        elif node[0] in (TEXT, GONE):
            if at >= len(symbols) or symbols[at] != node[0]:
                return -1
            slots.append(node[1])
            at += 1
        else:
            times = 0
            while True:
                mark = len(slots)
                after = match(node[1], symbols, at, slots)
                if after <= at:
                    del slots[mark:]
                    times += after == at  # a group of optional nodes may stand for nothing
                    break
                at, times = after, times + 1
                if node[0] == "?":
                    break
            if node[0] == "+" and not times:
                return -1
    return at


def _wanted(texts: list[tuple[str, bool, bool]]) -> list[bool]:
    """Which of a page's texts are main text: those in its articles if it has any, else all that nothing drops."""
    article = any(inside and kept for _, kept, inside in texts)
    return [kept and (inside or not article) for _, kept, inside in texts]


def _judged(nodes: list, votes: dict[int, int]) -> str:
    return json.dumps([nodes, sorted(s for s, v in votes.items() if v > 0), sorted(s for s, v in votes.items() if v <= 0)])


def learn(pages: list[str]) -> str:
    """The wrapper of the pages and the numbers of its slots of main text and of others, as JSON."""
    streams = [stream(p) for p in pages]
    folded = [fold(symbols) for symbols, _ in streams]
    numbered = number(reduce(align, folded) if folded else [], [0])
    votes: dict[int, int] = defaultdict(int)
    for symbols, texts in streams:
        for slot, vote in _votes(numbered, symbols, _wanted(texts)):
            votes[slot] += vote
    return _judged(numbered, votes)


def _votes(nodes: list, symbols: list[str], wanted: list[bool]) -> Iterator[tuple[int, int]]:
    """(slot, 1 for main text or -1) of each text of a page that the wrapper matches."""
    slots: list[int] = []
    if match(nodes, symbols, 0, slots) == len(symbols):
        yield from ((slot, 1 if w else -1) for slot, w in zip(slots, wanted))


class Wrapper:
    def __init__(self, learnt: str | None):
        self.nodes, main, other = json.loads(learnt) if learnt else ([], [], [])
        self.main, self.seen = set(main), {*main, *other}

    def text(self, page: str | None) -> str:
        symbols, texts = stream(page or "")
        wanted, slots = _wanted(texts), []
        if self.seen and match(self.nodes, symbols, 0, slots) == len(symbols):
            # A slot that no page filled when votes were counted is judged by the page itself.
            wanted = [s in self.main if s in self.seen else w for s, w in zip(slots, wanted)]
        return "\n\n".join(t[0] for t, w in zip(texts, wanted) if w)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[^/?#]*//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, shape, n): the streams of a task's pages with their texts' marks, 1 for main text, and how many pages have each."""
    pages: dict[tuple[str, str], int] = defaultdict(int)
    held = 0

    def counted() -> pa.RecordBatch:
        hosts, shapes = zip(*pages)
        parts = [pa.array(hosts, pa.string()), pa.array(shapes, pa.string()), pa.array(pages.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(parts, ["host", "shape", "n"])

    for batch in small(batches, 64):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("body").to_pylist()):
            symbols, texts = stream(page)
            if not symbols:
                continue
            shape = json.dumps([symbols, "".join("01"[w] for w in _wanted(texts))])
            held += 0 if (host, shape) in pages else len(shape)
            pages[host, shape] += 1
        if held > 1 << 24:
            yield counted()
            pages.clear()
            held = 0
    if pages:
        yield counted()


def page_shapes(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """(host, shape, n): the distinct streams of each host, with the number of its pages that have them."""
    named = pages.filter(F.col(body).isNotNull()).select(host_of(F.col(url)).alias("host"), F.col(body).alias("body"))
    return named.mapInArrow(_shapes, "host string, shape string, n long").groupBy("host", "shape").agg(F.sum("n").alias("n"))


def _picked(pages: DataFrame, url: str, body: str, sample: int) -> DataFrame:
    """At most ``sample`` different pages of each host, those that hash lowest; no task sorts whole pages."""
    named = pages.withColumns({"__host": host_of(F.col(url)), "__h": F.xxhash64(body)}).filter(F.col(body).isNotNull())
    order = Window.partitionBy("__host").orderBy("__h")
    picked = named.select("__host", "__h").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)
    return named.join(stored(picked.drop("n"), "picked"), ["__host", "__h"], "left_semi")


def _aligned(shapes: DataFrame) -> DataFrame:
    """(host, wrapper): all shapes of each host aligned, in rounds, each of which leaves about one wrapper of ``TOGETHER``."""

    def folded(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        return {"wrapper": pa.array([_plain(fold(json.loads(x)[0])) for x in batch.column("shape").to_pylist()], pa.string())}

    def numbered(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        return {"wrapper": pa.array([_judged(number(json.loads(x), [0]), {}) for x in batch.column("wrapper").to_pylist()], pa.string())}

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        wrapper = reduce(align, map(json.loads, sorted(rows["wrapper"])))
        return pd.DataFrame({"host": rows["host"].iloc[:1], "wrapper": [_plain(wrapper)]})

    given = shapes.select("host", "shape")
    left = stored(given.mapInArrow(add_columns(folded), schema_with(given, wrapper="string")).select("host", "wrapper").distinct(), "folded")
    while True:
        groups = left.groupBy("host").agg(F.ceil(F.count("*") / TOGETHER).alias("groups"), F.count("*").alias("n"))
        if (groups.agg(F.max("n")).first()[0] or 1) == 1:
            break
        group = F.pmod(F.xxhash64("wrapper"), F.col("groups")).alias("group")
        dealt = left.join(groups, "host").select("host", "wrapper", group)
        left = stored(dealt.groupBy("host", "group").applyInPandas(merge, "host string, wrapper string"), "aligned")
    return stored(left.mapInArrow(add_columns(numbered), schema_with(left, wrapper="string")), "wrappers")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, slot, votes) of the pages of a task's shapes."""
    nodes: dict[str, list] = {}
    votes: dict[tuple[str, int], int] = defaultdict(int)

    def counted() -> pa.RecordBatch:
        hosts, slots = zip(*votes)
        parts = [pa.array(hosts, pa.string()), pa.array(slots, pa.int32()), pa.array(votes.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(parts, ["host", "slot", "votes"])

    for batch in small(batches):
        columns = (batch.column(n).to_pylist() for n in ("host", "wrapper", "shape", "n"))
        for host, learnt, shape, n in zip(*columns):
            if learnt not in nodes:
                if len(nodes) > 1000:
                    nodes.clear()
                nodes[learnt] = json.loads(learnt)[0]
            symbols, wanted = json.loads(shape)
            for slot, vote in _votes(nodes[learnt], symbols, [w == "1" for w in wanted]):
                votes[host, slot] += vote * n
        if len(votes) > 1 << 16:
            yield counted()
            votes.clear()
    if votes:
        yield counted()


def fit_wrappers(pages: DataFrame, url: str = "url", body: str = "html", sample: int | None = None) -> DataFrame:
    """(host, wrapper), from all pages of each host, their slots judged by all of them. With ``sample``, at most so many pages are
    aligned; all judge."""
    shapes = stored(page_shapes(pages, url, body), "shapes")
    learnt = _aligned(shapes if sample is None else page_shapes(_picked(pages, url, body, sample), url, body))
    # Wrappers are few and short; Spark broadcasts them if they measure so, else AQE splits a large host's shapes.
    counts = shapes.join(learnt, "host").select("host", "wrapper", "shape", "n").mapInArrow(_count, "host string, slot int, votes long")
    counts = counts.groupBy("host", "slot").agg(F.sum("votes").alias("votes"))
    by_host = counts.groupBy("host").agg(F.collect_list("slot").alias("slots"), F.collect_list("votes").alias("votes"))

    def make(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        columns = (batch.column(n).to_pylist() for n in ("wrapper", "slots", "votes"))
        return {"wrapper": pa.array([_judged(json.loads(w)[0], dict(zip(s or (), v or ()))) for w, s, v in zip(*columns)], pa.string())}

    both = learnt.join(by_host, "host", "left")
    return both.mapInArrow(add_columns(make), schema_with(both, wrapper="string")).select("host", "wrapper")


def _read(body: str):
    wrappers: dict[str | None, Wrapper] = {}

    def make(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        out = []
        for page, learnt in zip(batch.column(body).to_pylist(), batch.column("__wrapper").to_pylist()):
            if learnt not in wrappers:
                if len(wrappers) > 1000:
                    wrappers.clear()
                wrappers[learnt] = Wrapper(learnt)
            out.append(wrappers[learnt].text(page))
        return {"text": pa.array(out, pa.string()), "n_chars": pa.array([len(t) for t in out], pa.int64())}

    return make


def extract(pages: DataFrame, url: str = "url", body: str = "html", sample: int | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points."""
    learnt = stored(fit_wrappers(pages, url, body, sample), "judged")
    kept = pages.drop("text", "n_chars").withColumn("__host", host_of(F.col(url)))
    # As above: a broadcast, or a join whose large hosts AQE splits.
    joined = kept.join(learnt.select(F.col("host").alias("__host"), F.col("wrapper").alias("__wrapper")), "__host", "left")
    schema = schema_with(joined, text="string", n_chars="long")
    return joined.mapInArrow(add_columns(_read(body)), schema).drop("__host", "__wrapper")
