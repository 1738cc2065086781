"""Periodic runs of words: maximal stretches with a period, found with suffix trees, for collapsing looped text.

A run of period q is a stretch of at least max(``shortest``, 3 q) words in which words q apart are identical, which no neighbouring
word extends. By the runs theorem (Bannai et al., 2017) each run holds a Lyndon root of length q that is, in one of two orders of
the words, the longest Lyndon word at its place: it ends where the next smaller suffix begins. So each place has two candidate
roots. Each is extended to both sides by the longest common extension of its ends: the string depth of the lowest common
ancestor of two leaves, in constant time from the Euler tour of Ukkonen's suffix tree; to the left, in the tree of the reversal.

Every place of a run lies three times in it, whole periods apart. A word with less than three places in a stretch is thus in no run, and
borders none that could go on, so stretches are cut at such words, again and again, before trees are built. The cut loses nothing.

Null texts have no words. Texts of any length are read whole; trees take memory in proportion to the longest stretch that is left. Null ids and
repeated rows stay as they are. An empty table gives an empty table. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import add_columns, schema_with

# Entries of an Euler tour that share a block; only minima of blocks are in the sparse table.
_BLOCK = 32
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols``, positive numbers, behind which a 0 is put. Nodes are numbers, the root is 0."""

    def __init__(self, symbols: list[int]):
        self.symbols = symbols = [*symbols, 0]
        self.first, self.end, self.children = [0], [0], [{}]
        self._build()

    def _build(self) -> None:
        s, first, end, children = self.symbols, self.first, self.end, self.children
        n = len(s)
        link = [0]
        node = edge = length = waiting = 0
        for pos in range(n):
            symbol = s[pos]
            waiting += 1
            unlinked = -1
            while waiting:
                if not length:
                    edge = pos
                head = s[edge]
                below = children[node]
                child = below.get(head)
                if child is None:
                    below[head] = len(first)
                    first.append(pos)
                    end.append(n)
                    children.append(None)
                    link.append(0)
                    if unlinked >= 0:
                        link[unlinked] = node
                        unlinked = -1
                else:
                    stop = end[child]
                    span = (stop if stop <= pos else pos + 1) - first[child]
                    if length >= span and children[child] is not None:
                        edge += span
                        length -= span
                        node = child
                        continue
                    begin = first[child]
                    if s[begin + length] == symbol:
                        length += 1
                        if unlinked >= 0:
                            link[unlinked] = node
                        break
                    fork = len(first)
                    below[head] = fork
                    children[node] = below
                    first.append(begin)
                    end.append(begin + length)
                    link.append(0)
                    first[child] = begin + length
                    leaf = fork + 1
                    children.append({symbol: leaf, s[begin + length]: child})
                    first.append(pos)
                    end.append(n)
                    children.append(None)
                    link.append(0)
                    if unlinked >= 0:
                        link[unlinked] = fork
                    unlinked = fork
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = pos - waiting + 1

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """(string depths along the Euler tour, place in the tour of the leaf of each suffix)."""
        first, end, children = self.first, self.end, self.children
        n = len(self.symbols)
        depth = [0] * len(first)
        depths, at = [], np.zeros(n, np.int64)
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:
                depths.append(depth[~node])
                continue
            below = children[node]
            if below is None:
                at[n - depth[node]] = len(depths)
                depths.append(depth[node])
                continue
            here = depth[node]
            depths.append(here)
            again = ~node
            for symbol in sorted(below, reverse=True):
                child = below[symbol]
                depth[child] = here + end[child] - first[child]
                stack.append(again)
                stack.append(child)
        return np.array(depths, np.int32), at

    def ranks_with_end_last(self) -> list[int]:
        """The rank of every suffix where the end of the text comes after every symbol."""
        first, end, children = self.first, self.end, self.children
        n = len(self.symbols)
        last = max(self.symbols) + 1
        rank, seen = [0] * n, 0
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = children[node]
            if below is None:
                rank[n - depth] = seen
                seen += 1
                continue
            for symbol in sorted(below, key=lambda x: x or last, reverse=True):
                child = below[symbol]
                stack.append((child, depth + end[child] - first[child]))
        return rank


class CommonExtensions:
    """Longest common extensions of pairs of suffixes: range minima over the Euler tour, in constant time each."""

    def __init__(self, depths: np.ndarray, at: np.ndarray):
        self.at = at
        blocks = -(-len(depths) // _BLOCK)
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(depths)] = depths
        grid = padded.reshape(blocks, _BLOCK)
        self.flat = padded
        self.from_start = np.minimum.accumulate(grid, axis=1).ravel()
        self.to_end = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [grid.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of equal symbols from ``a[i]`` and from ``b[i]`` on; ``a[i]`` and ``b[i]`` differ."""
        x, y = self.at[a], self.at[b]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        lo_block, hi_block = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.to_end[lo], self.from_start[hi])
        inside = lo_block == hi_block
        if inside.any():
            left, right = lo[inside], hi[inside]
            least = self.flat[left]
            for step in range(1, _BLOCK):
                least = np.minimum(least, self.flat[np.minimum(left + step, right)])
            out[inside] = least
        count = hi_block - lo_block - 1
        level = np.frexp(np.maximum(count, 1))[1] - 1
        for k in np.unique(level[count > 0]):
            some = (level == k) & (count > 0)
            table = self.levels[k]
            begin, stop = lo_block[some] + 1, hi_block[some] - (1 << int(k))
            out[some] = np.minimum(out[some], np.minimum(table[begin], table[stop]))
        return out


def _next_smaller(ranks: list[int]) -> np.ndarray:
    """For each suffix the first later one of lower rank; the last entry belongs to the end of the text."""
    n = len(ranks) - 1
    found, stack = np.full(n, n, np.int64), []
    for i in range(n - 1, -1, -1):
        mine = ranks[i]
        while stack and ranks[stack[-1]] > mine:
            stack.pop()
        if stack:
            found[i] = stack[-1]
        stack.append(i)
    return found


def runs_of(symbols: list[int], shortest: int = 24) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least max(``shortest``, 3 periods) symbols, in order."""
    n = len(symbols)
    tree = SuffixTree(symbols)
    depths, at = tree.tour()
    ahead = CommonExtensions(depths, at)
    back = CommonExtensions(*SuffixTree(symbols[::-1]).tour())
    ranks = np.empty(n + 1, np.int64)
    ranks[np.argsort(at)] = np.arange(n + 1)
    # The other order turns the words' order around but keeps the end lowest: its reversal has the end last.
    turned = [n - r for r in tree.ranks_with_end_last()]
    found = set()
    for order in (ranks.tolist(), turned):
        period = _next_smaller(order) - np.arange(n)
        i = np.flatnonzero((period * 3 <= n) & (np.arange(n) + period < n))
        p = period[i]
        right = ahead(i, i + p).astype(np.int64)
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = back(n - i[inner], n - i[inner] - p[inner])
        length = left + p + right
        keep = length >= np.maximum(shortest, 3 * p)
        found.update(zip((i - left)[keep].tolist(), length[keep].tolist(), p[keep].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that are left when words with less than three places in theirs are cut out."""
    out, open_ = [], [(0, len(ids))]
    while open_:
        begin, end = open_.pop()
        if end - begin < shortest:
            continue
        kinds, at, counts = np.unique(ids[begin:end], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[at] < 3)
        if not len(rare):
            out.append((begin, end))
            continue
        cuts = np.concatenate(([-1], rare, [end - begin]))
        for k in np.flatnonzero(np.diff(cuts) > shortest):
            open_.append((begin + int(cuts[k]) + 1, begin + int(cuts[k + 1])))
    return sorted(out)


def word_runs(words: list[bytes], shortest: int = 24) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    if len(words) < shortest:
        return []
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    for begin, end in _stretches(ids, shortest):
        _, symbols = np.unique(ids[begin:end], return_inverse=True)
        found += [(begin + s, n, p) for s, n, p in runs_of((symbols + 1).tolist(), shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        inside = np.cumsum(edges[:-1]) > 0
        words = [w for w, gone in zip(words, inside.tolist()) if not gone]
    return b" ".join(words)


def find_runs(docs: DataFrame, text: str = "text", shortest: int = 24, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period: by start, then period) and ``collapsed``.

    ``collapsed`` has the words, by single spaces, that lie in no run after its first period. With ``keep_text=False`` the
    text itself is not handed back.
    """

    def make(batch: pa.RecordBatch, before: int) -> dict[str, pa.Array]:
        counts, runs, kept = [], [], []
        for value in batch.column("collapsed"):
            words = (value.as_py() or b"").split()
            mine = word_runs(words, shortest)
            counts.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
            kept.append(_collapsed(words, mine))
        return {
            "n_words": pa.array(counts, pa.int64()),
            "runs": pa.array(runs, _RUN_TYPE),
            "collapsed": pa.array(kept, pa.binary()),
        }

    kept = docs.drop(*{"n_words", "runs", "collapsed"} - {text})
    others = [c for c in kept.columns if c != text or (keep_text and text not in ("n_words", "runs", "collapsed"))]
    ready = kept.select(*others, F.col(text).cast("binary").alias("collapsed"))
    found = ready.mapInArrow(add_columns(make), schema_with(ready, n_words="long", runs=_RUNS, collapsed="binary"))
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: str = "runs") -> Column:
    """The run of greatest length in periods (ties: smallest start, then period); null without runs."""

    def better(best: Column, run: Column) -> Column:
        # Runs come by start, then period, so an equal one is a later one.
        ahead = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | ahead, run).otherwise(best)

    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, nothing, better)


def looped(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where the tail of every tenth text, chosen by the hash of its id, goes round in a loop.

    With h = crc32 of the decimal id and g = h / 10: if 10 divides h and the text has words, each word i >= a = g mod n
    becomes word a + (i - a) mod p, where p = 1 + (n - a) / (3 + g mod 8). All else stays, white space as well.
    """
    h = F.crc32(F.col(ids).cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = docs.withColumn("__h", h).withColumn("__w", F.when(F.col("__h") % 10 == 0, words))
    n, g = F.size("__w"), F.expr("__h div 10")
    a = (g % n).cast("int")
    p = F.expr("1 + (size(__w) - __a) div (3 + (__h div 10) % 8)").cast("int")
    tail = F.expr("transform(sequence(__a, size(__w) - 1), i -> __w[__a + (i - __a) % __p])")
    spun = F.concat_ws(" ", F.concat(F.slice("__w", 1, F.col("__a")), tail))
    has_words = F.coalesce(n > 0, F.lit(False))
    marked = marked.withColumn("__a", F.when(has_words, a)).withColumn("__p", p)
    return marked.withColumn(text, F.when(F.col("__a").isNotNull(), spun).otherwise(F.col(text))).select(*docs.columns)
