"""Near-duplicate passages across documents, by compact windows over min-hashed shingles.

A text is its sequence of five-word shingles. For one hash function, a compact window (l, c, r) stands for all stretches between l and r that
hold c: the hash at c is the least of each of them. Windows come from the Cartesian tree of the hashes; only those at least as long as
the shortest passage are kept, about 2n / t for n shingles. Stretches of two texts that are alike share the least hash for most of the hash
functions, so their windows meet under the same signature (function, least hash).

The windows of a signature are linked to the first of them, so n windows give n - 1 links. Inside a task only windows are dropped for the
first that hold no passage around their centres which it does not hold as well. After the shuffle a first window may share no more than the shingle with the others, so
signatures with three windows or more are looked at again: their windows are linked by the ``CONTEXT`` shingles to each side of the centre, and
passages of the least length by the hash of all their words. A passage with the centre has half its length on one side of it, so
only the passages around halves that two documents share are looked at. The links of two documents are then joined as intervals: those that overlap and
lie on nearly the same diagonal are one candidate, kept if enough hash functions agree or whole passages do. Each candidate is verified on the words themselves: runs of
shared shingles with a Jaccard similarity of ``similarity`` or more, or verbatim runs, of at least ``least`` words.

Words are as in :func:`joined_words`, shingles are compared by 64-bit hashes. Null, empty and short texts have no passages. Texts of over ``STRETCH`` words are windowed in stretches that overlap by two
passages. Repeated rows, and texts that are equal, share passages like any others; a null id is reported as null. Passages that repeat inside one document only are not reported.
An empty table gives an empty table. Only the id and the text are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import (
    add_columns,
    components,
    joined_words,
    row_ids,
    schema_with,
    small,
    stored,
    word_bytes,
)

WIDTH = 5
HASHES = 4
# Hash functions that must agree before words are compared.
ENOUGH = 2
# How far the diagonals of windows of one candidate may differ, in words.
SLACK = 12
# Shingles without a partner that a passage may hold in a row: two edits side by side.
GAP = 12
# Shingles to each side of a centre that tell windows of one signature apart, and the function number of a whole passage.
CONTEXT, WHOLE = 5, 7
# Rounds in which the windows of a signature are linked to a first one inside a task; those left are shuffled.
_ROUNDS = 8
STRETCH, _CHUNK = 1 << 20, 1 << 16
# Bytes that are hashed at a time, and windows of one signature that a task holds before it keeps one for each context and half.
_PIECE, _RUN = 1 << 18, 1 << 18
_PLACE = np.uint64((1 << 28) - 1)
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, HASHES, dtype=np.uint64)
_BYTES = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
# A window in two numbers: eight times its centre plus its hash function, and its reach to the left and to the right.
_NAMES = ("rid", "hub", "at", "ext", "hub_at", "hub_ext")
_LINK = ", ".join(f"{n} long" for n in _NAMES)
_HELD = 1 << 16
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _mixed(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    h = (h ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))


def _run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` places."""
    if len(hashes) < length:
        return np.empty(0, np.uint64)
    seed = lambda n: np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))
    out = np.zeros(len(hashes) - length + 1, np.uint64)
    # Runs of powers of two, put together from halves.
    part, size, done = hashes, 1, 0
    while True:
        if length & size:
            out = _mixed(out, seed(2 * size + 1)) ^ part[done : done + len(out)]
            done += size
        if done == length:
            return _mixed(out, seed(length))
        part = _mixed(part[:-size], seed(2 * size)) ^ part[size:]
        size *= 2


def _word_hashes(joined: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word; ``starts`` are the first bytes of words that all end with a space: sums of bytes times powers, then mixed."""
    out = np.empty(len(starts), np.uint64)
    first = np.unique(np.searchsorted(starts, np.arange(0, len(joined), _PIECE)))
    first = first[first < len(starts)]
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(starts)]):
        end = int(starts[j]) if j < len(starts) else len(joined)
        at, part = starts[i:j] - starts[i], joined[starts[i] : end]
        lengths = np.diff(at, append=len(part))
        power = np.full(int(lengths.max()), _BASE)
        power[0] = 1
        power = np.multiply.accumulate(power)
        place = np.arange(len(part)) - np.repeat(at, lengths)
        out[i:j] = _mixed(np.add.reduceat(_BYTES[part] * power[place], at), _BASE)
    return out


def shingles(texts: list[bytes]) -> np.ndarray:
    """Of texts of one word or more, as :func:`joined_words` gives them, one after another: the hash of the five words from each word on, or
    zero for the last four of a text."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(joined == 32)[:-1] + 1))
    hashes = _run_hashes(_word_hashes(joined, starts), WIDTH)
    hashes = np.concatenate((hashes, np.zeros(len(starts) - len(hashes), np.uint64)))
    ends = np.cumsum([x.count(b" ") + 1 for x in texts])
    for k in range(1, WIDTH):
        hashes[ends - k] = 0  # of a text of fewer words, these are the last of the text before
    return hashes


def compact_windows(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r), ends included, of every compact window of at least ``least`` places. A value of zero is a wall.

    Equal values count as smaller on the left. The centres are the places of the least value of each stretch of ``least`` places.
    A window ends before the nearest smaller values, its ancestors in the Cartesian tree. Those stand for longer windows and so are centres
    (or walls) themselves: the ends are found among the centres, from minima over powers of two.
    """
    n = len(values)
    none = np.empty(0, np.int64)
    if n < least:
        return none, none, none
    # Value and place in one number: minima then carry their place, and no two are equal.
    stretch = (values & ~_PLACE) | np.arange(n, dtype=np.uint64)
    size = 1
    while size < least:
        step = min(size, least - size)
        stretch = np.minimum(stretch[:-step], stretch[step:])
        size += step
    own = stretch[np.concatenate(([True], stretch[1:] != stretch[:-1]))]  # places only go up from stretch to stretch
    at = (own & _PLACE).astype(np.int64)
    m = len(own)
    minima, size = [own], 1  # minima[j][x]: over the 2^j centres from x on
    while 2 * size <= m:
        minima.append(np.minimum(minima[-1][:-size], minima[-1][size:]))
        size *= 2
    left, right = np.arange(m), np.arange(m)  # the first and the last centre of the window so far
    for j in range(len(minima) - 1, -1, -1):
        step = 1 << j
        clear = (left >= step) & (minima[j][np.maximum(left - step, 0)] > own)
        left = left - step * clear
        clear = (right + step < m) & (minima[j][np.minimum(right + 1, m - step)] > own)
        right = right + step * clear
    l = np.where(left > 0, at[left - 1] + 1, 0)
    r = np.where(right + 1 < m, at[np.minimum(right + 1, m - 1)] - 1, n - 1)
    centre = values[at] > _PLACE
    return l[centre], at[centre], r[centre]


def _chunks(texts: pa.Array, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, row, place) of many texts in a row, zeros between them."""

    def chunk(held: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, parts, sizes = zip(*held)
        return shingles(list(parts)), np.repeat(row, sizes), np.concatenate([np.arange(n) for n in sizes])

    held, words = [], 0
    for i, value in enumerate(texts):
        text = value.as_py()
        joined = joined_words(text) if text and len(text) >= 2 * shortest else b""
        n = joined.count(b" ") + 1
        if n < shortest + WIDTH - 1:
            continue
        if n > STRETCH:
            hashes = shingles([joined])
            for at in range(0, n, STRETCH):
                first = max(0, at - 2 * shortest)
                part = np.append(hashes[first : at + STRETCH], np.uint64(0))
                yield part, np.full(len(part), i), np.arange(first, first + len(part))
            continue
        held.append((i, joined, n))
        words += n
        if words >= _CHUNK:
            yield chunk(held)
            held, words = [], 0
    if held:
        yield chunk(held)


def _links_of_runs(sig: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by (sig, rid): the first of each run, and (row, first) for the others that are of another document."""
    first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.empty(0, bool)
    hub = np.flatnonzero(first)[np.cumsum(first) - 1] if len(sig) else np.empty(0, np.int64)
    other = np.flatnonzero(rid != rid[hub]) if len(sig) else hub
    return np.flatnonzero(first), np.stack((other, hub[other])) if len(sig) else np.empty((2, 0), np.int64)


def _batch(rid, hub, member, first, **key) -> pa.RecordBatch:
    parts = dict(key, rid=rid, hub=hub, at=member[0], ext=member[1], hub_at=first[0], hub_ext=first[1])
    return pa.RecordBatch.from_pydict({n: pa.array(p) for n, p in parts.items()})


def _same_around(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, ext: np.ndarray, shortest: int) -> np.ndarray:
    """Whether all runs of ``shortest`` shingles around the centre ``a`` of a window of reach ``ext`` are around ``b`` too. Zeros are walls, also at
    both ends."""
    same = hashes[a] == hashes[b]
    for way, reach in ((-1, ext >> 32), (1, ext & ((1 << 32) - 1))):
        going = np.flatnonzero(same)
        for k in range(1, shortest):
            going = going[reach[going] >= k]
            if not len(going):
                break
            equal = hashes[a[going] + way * k] == hashes[b[going] + way * k]
            same[going[~equal]] = False  # a wall there ends it too, for there is none within the reach
            going = going[equal]
    return same


def _tell(hashes: np.ndarray, c: np.ndarray, l: np.ndarray, r: np.ndarray, shortest: int) -> np.ndarray:
    """What tells the windows of one signature apart: 32 bits of the ``CONTEXT`` shingles to each side of the centre, 16 bits each of the half passage
    that ends with the centre and of that which begins with it; zero where there is none."""
    half, walls = (shortest + 1) // 2, np.concatenate(([0], np.cumsum(hashes == 0)))

    def bits(length: int, start: np.ndarray, there: np.ndarray, n: int) -> np.ndarray:
        runs, out = _run_hashes(hashes, length), np.zeros(len(start), np.uint64)
        out[there] = runs[start[there]] >> np.uint64(64 - n) | np.uint64(1)
        return out

    near = (c >= CONTEXT) & (c + CONTEXT < len(hashes))
    near[near] = walls[c[near] + CONTEXT + 1] == walls[c[near] - CONTEXT]
    context = bits(2 * CONTEXT + 1, c - CONTEXT, near, 32)
    start = np.concatenate((c - half + 1, c))
    before, after = np.split(bits(half, start, np.concatenate((c - half + 1 >= l, c + half - 1 <= r)), 16), 2)
    return (context << np.uint64(32) | before << np.uint64(16) | after).view(np.int64)


def _windows(shortest: int):
    """Windows to be shuffled by signature (``hub`` -1, ``hub_at`` as of :func:`_tell`), and links already found on the way, dealt out by their
    document."""

    def linked(found: list[tuple[np.ndarray, ...]], chunks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate((np.zeros(1, np.uint64), *chunks))
        sig, rid, at, ext, here, tell = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(sig, kind="stable")  # documents are in order already, for each hash function
        sig, rid, at, ext, here, tell = (x[order] for x in (sig, rid, at, ext, here, tell))
        kept, left = np.ones(len(sig), bool), np.arange(len(sig))
        for _ in range(_ROUNDS):
            first = np.concatenate(([True], sig[left[1:]] != sig[left[:-1]]))
            hub, left = left[np.flatnonzero(first)[np.cumsum(first) - 1]][~first], left[~first]
            if not len(left):
                break
            alike = tell[left] == tell[hub]
            alike[alike] = _same_around(hashes, here[left[alike]], here[hub[alike]], ext[left[alike]], shortest)
            a, b = left[alike], hub[alike]
            kept[a] = False
            a, b = a[rid[a] != rid[b]], b[rid[a] != rid[b]]
            if len(a):
                sure = at[a] | WHOLE
                yield _batch(rid[a], rid[b], (sure, ext[a]), (at[b] | WHOLE, ext[b]), key=rid[a] * np.int64(0x9E3779B1))
            left = left[~alike]
            if not len(left):
                break
        kept = np.flatnonzero(kept)
        kept = kept[np.argsort(here[kept])]  # rows of one text together take less room in the shuffle
        none = np.full(len(kept), -1)
        yield _batch(rid[kept], none, (at[kept], ext[kept]), (tell[kept], none), key=sig[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column("rid").to_numpy()
            found, chunks, held, before = [], [], 0, 1
            for hashes, row, place in _chunks(batch.column("text"), shortest):
                wall = hashes == 0
                ends = []
                for f, seed in enumerate(_SEEDS):
                    v = _mixed(hashes, seed)
                    order = v | (_PLACE + np.uint64(1))
                    order[wall] = 0
                    l, c, r = compact_windows(order, shortest)
                    ends.append((l, c, r, v[c].view(np.int64), place[c] * 8 + f))
                l, c, r, sig, at = (np.concatenate(x) for x in zip(*ends))
                found.append((sig, rids[row[c]], at, (c - l << 32) + (r - c), c + before, _tell(hashes, c, l, r, shortest)))
                held += len(c)
                chunks.append(hashes)
                before += len(hashes)
                if held >= _HELD:
                    yield from linked(found, chunks)
                    found, chunks, held, before = [], [], 0, 1
            if held:
                yield from linked(found, chunks)

    return run


def _contested(shortest: int):
    """(key, rid, at) of every run of ``shortest`` shingles around the centre of a window, by all its words, from documents with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 64):
            texts = [joined_words(x) for x in batch.column("text").to_pylist()]
            hashes, sizes = shingles(texts), np.array([x.count(b" ") + 1 for x in texts])
            before = np.cumsum(sizes) - sizes
            windows = batch.column("windows")
            at, ext = (windows.flatten().field(n).to_numpy() for n in ("at", "ext"))
            c = (at >> 3) + np.repeat(before, pa.compute.list_value_length(windows).to_numpy())
            l, r = c - (ext >> 32), c + (ext & ((1 << 32) - 1))
            steps = np.bincount(np.maximum(l, c - shortest + 1), minlength=len(hashes) + 1)
            steps -= np.bincount(np.minimum(c, r - shortest + 1) + 1, minlength=len(hashes) + 1)
            start = np.flatnonzero(np.cumsum(steps)[:-1])
            doc = np.repeat(np.arange(len(sizes)), sizes)[start]
            key = _run_hashes(hashes, shortest)[start].view(np.int64)
            rid, at = batch.column("rid").to_numpy()[doc], (start - before[doc]) * 8 + WHOLE
            yield pa.RecordBatch.from_pydict({"key": pa.array(key), "rid": pa.array(rid), "at": pa.array(at)})

    return run


def _again(sig: np.ndarray, rid: np.ndarray, ext: np.ndarray, tell: np.ndarray, shortest: int):
    """Of the windows of contested signatures, sorted by (sig, rid): (row, first) of those of one context, and the rows whose passages are to be
    looked at, with their reach, which is cut to the side of a half that two documents share."""
    run = np.cumsum(np.concatenate(([0], sig[1:] != sig[:-1])))
    shared = []
    for shift in (16, 0):
        half = run << 16 | tell >> shift & 0xFFFF
        order = np.argsort(half, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], half[order[1:]] != half[order[:-1]])))
        ends = np.append(starts[1:], len(order))
        both = np.empty(len(order), bool)
        both[order] = np.repeat(rid[order[starts]] != rid[order[ends - 1]], ends - starts)
        shared.append(both & (tell >> shift & 0xFFFF > 0))
    most = shortest - (shortest + 1) // 2
    left, right = ext >> 32, ext & ((1 << 32) - 1)
    ext = (np.where(shared[0], left, np.minimum(left, most)) << 32) + np.where(shared[1], right, np.minimum(right, most))
    look = np.flatnonzero(shared[0] | shared[1])
    near = np.flatnonzero(tell >> 32 != 0)
    near = near[np.argsort(run[near] << 32 | (tell[near] >> 32 & 0xFFFFFFFF), kind="stable")]
    context = run[near] << 32 | (tell[near] >> 32 & 0xFFFFFFFF)
    _, links = _links_of_runs(context, rid[near])
    return near[links], look, ext[look]


def _link_windows(shortest: int):
    """Links from rows sorted by (key, hub, rid), and the windows (``hub`` -1) of runs of three or more whose passages are to be looked at."""

    def linked(rows: list[np.ndarray], dropped: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        sig, rid, at, ext, tell = rows
        hubs, (a, b) = _links_of_runs(sig, rid)
        size = np.diff(np.append(hubs, len(sig)))
        many = np.flatnonzero(np.repeat(size > 2, size))
        if len(many):
            (x, y), look, reach = _again(*(v[many] for v in (sig, rid, ext, tell)), shortest)
            other = many[y] != np.repeat(hubs, size)[many[x]]
            a, b = np.append(a, many[x[other]]), np.append(b, many[y[other]])
            look = many[look]
            if dropped is not None:
                more = np.setdiff1d(np.flatnonzero(dropped), look)
                look, reach = np.append(look, more), np.append(reach, ext[more])
            if len(look):
                none = np.full(len(look), -1)
                yield _batch(rid[look], none, (at[look], reach), (none, none))
        if len(a):
            yield _batch(rid[a], rid[b], (at[a], ext[a]), (at[b], ext[b]))

    def firsts(tell: np.ndarray) -> np.ndarray:
        """Whether a window of one signature is the first, or the first of its context or of a half."""
        first = np.zeros(len(tell), bool)
        for part in (tell >> 32, tell >> 16 & 0xFFFF, tell & 0xFFFF):
            first[np.unique(part, return_index=True)[1]] = True
        return first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # of the run that the next batch may go on with
        most = _RUN
        for batch in batches:
            made = batch.filter(pa.compute.greater_equal(batch.column("hub"), 0))
            if made.num_rows:
                yield made.select(list(_NAMES))
            new = batch.filter(pa.compute.less(batch.column("hub"), 0))
            if not new.num_rows:
                continue
            held.append([new.column(n).to_numpy() for n in ("key", "rid", "at", "ext", "hub_at")])
            key = held[-1][0]
            if key[-1] != held[0][0][0]:
                rows = [np.concatenate(x) for x in zip(*held)]
                end = int(np.flatnonzero(rows[0] != rows[0][-1])[-1]) + 1
                yield from linked([x[:end] for x in rows])
                held, most = [[x[end:] for x in rows]], _RUN
            elif sum(len(x[0]) for x in held) > most:
                # Of a long run stay the windows that later ones may be linked to; what the others share is looked at in any case.
                rows = [np.concatenate(x) for x in zip(*held)]
                first = firsts(rows[4])
                yield from linked(rows, ~first)
                held = [[x[first] for x in rows]]
                most = _RUN + 4 * int(first.sum())
        if held:
            yield from linked([np.concatenate(x) for x in zip(*held)])

    return run


def _link_passages(shortest: int):
    """Links from rows (key, rid, at) sorted by (key, rid)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None  # the first of the run that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(n).to_numpy() for n in ("key", "rid", "at")]
            if last is not None and last[0][0] == rows[0][0]:
                rows = [np.concatenate(x) for x in zip(last, rows)]
            key, rid, at = rows
            hubs, (a, b) = _links_of_runs(key, rid)
            last = [x[hubs[-1] : hubs[-1] + 1] for x in rows]
            if len(a):
                ext = np.full(len(a), shortest - 1)
                yield _batch(rid[a], rid[b], (at[a], ext), (at[b], ext))

    return run


def _unpacked(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    c, hc = rows["at"] >> 3, rows["hub_at"] >> 3
    reach = (1 << 32) - 1
    return {
        "rid": rows["rid"], "hub": rows["hub"], "f": rows["at"] & 7, "c": c, "hc": hc,
        "l": c - (rows["ext"] >> 32), "r": c + (rows["ext"] & reach),
        "hl": hc - (rows["hub_ext"] >> 32), "hr": hc + (rows["hub_ext"] & reach),
    }


def _join_intervals(enough: int):
    """Candidates (rid, hub, l, r, hl, hr) from links sorted by (rid, hub): the links of a pair are parted where their diagonals
    are further apart than ``SLACK``; in each part, those with overlapping windows are one if ``enough`` hash functions are among them."""

    def joined(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        x = _unpacked(rows)
        shift = x["c"] - x["hc"]
        order = np.lexsort((shift, x["hub"], x["rid"]))
        rid, hub, shift = x["rid"][order], x["hub"][order], shift[order]
        new = (rid[1:] != rid[:-1]) | (hub[1:] != hub[:-1]) | (np.diff(shift) > SLACK)
        band = np.empty(len(order), np.int64)
        band[order] = np.cumsum(np.concatenate(([0], new)))
        order = np.lexsort((x["c"], band))
        x, band = {n: v[order] for n, v in x.items()}, band[order]
        # The furthest end so far in the part: ends are below 2^32.
        reach = np.maximum.accumulate((band << 32) + x["r"])
        start = np.flatnonzero(np.concatenate(([True], (band[1:] << 32) + x["l"][1:] > reach[:-1])))
        functions = np.bitwise_or.reduceat(np.left_shift(1, x["f"]), start)
        agree = (np.bitwise_count(functions) >= enough) | (functions >> WHOLE > 0)
        cut = {n: how.reduceat(x[n], start)[agree].astype(np.int32) for n, how in (("l", np.minimum), ("r", np.maximum), ("hl", np.minimum), ("hr", np.maximum))}
        whom = {n: x[n][start][agree] for n in ("rid", "hub")}
        return pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in (whom | cut).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = {n: batch.column(n).to_numpy() for n in _NAMES}
            held = new if held is None else {n: np.concatenate((held[n], new[n])) for n in _NAMES}
            # The last pair of documents may go on in the next batch.
            end = int(np.flatnonzero((held["rid"] != held["rid"][-1]) | (held["hub"] != held["hub"][-1]))[-1:].sum() + 1)
            if end > 1 or (held["rid"][0], held["hub"][0]) != (held["rid"][-1], held["hub"][-1]):
                yield joined({n: v[:end] for n, v in held.items()})
                held = {n: v[end:] for n, v in held.items()}
        if held is not None and len(held["rid"]):
            yield joined(held)

    return run


def _cut_words(text: str | None, first: int, last: int) -> bytes:
    """The words of shingles ``first`` to ``last``."""
    joined, starts, ends = word_bytes(text)
    last = min(last + WIDTH - 1, len(starts) - 1)
    return joined[starts[first] : ends[last]] if first <= last else b""


def _cut(text: str, first: str, last: str, out: str):
    def make(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        columns = (batch.column(n).to_pylist() for n in (text, first, last))
        return {out: pa.array([_cut_words(*x) for x in zip(*columns)], pa.binary()), text: pa.nulls(batch.num_rows, pa.string())}

    return add_columns(make)


def shared_passages(a: np.ndarray, b: np.ndarray, shortest: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, start there, end there, similarity) in words, ends excluded, of the passages that two spans, given by their shingles, share."""
    if len(a) < shortest or len(b) < shortest:
        return []
    _, ids = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ids[: len(a)], ids[len(a) :]
    places, count = np.argsort(b, kind="stable"), np.bincount(b, minlength=len(ids))
    begin = np.cumsum(count) - count
    here = np.flatnonzero(count[a])
    if not len(here):
        return []
    # Follow the runs of shared shingles; of several places there, the one that goes on best.
    there, options = places[begin[a[here]]], count[a[here]]
    several = np.flatnonzero(options[1:] > 1) + 1
    listed = places.tolist() if len(several) else []
    for i, first, n, step in zip(*(x.tolist() for x in (several, begin[a[here]][several], options[several], np.diff(here)[several - 1]))):
        expected = int(there[i - 1]) + step
        k = bisect_left(listed, expected, first, first + n)
        there[i] = min(listed[max(first, k - 1) : min(k + 1, first + n)], key=lambda o: abs(o - expected))

    def passage(at: np.ndarray) -> tuple[int, int, int, int, float] | None:
        s, e, t, u = int(here[at[0]]), int(here[at[-1]]) + 1, int(there[at[0]]), int(there[at[-1]]) + 1
        if min(e - s, u - t) < shortest:
            return None
        x, y = set(a[s:e].tolist()), set(b[t:u].tolist())
        alike = len(x & y) / len(x | y)
        return (s, e + WIDTH - 1, t, u + WIDTH - 1, alike) if alike >= similarity else None

    steps, moved = np.diff(here), np.diff(there)

    def pieces(first: int, last: int, parted: np.ndarray) -> Iterator[np.ndarray]:
        """Of shared shingles ``first`` to ``last``, the parts between cuts that can be a passage."""
        cuts = np.concatenate(([first], first + 1 + np.flatnonzero(parted[first : last - 1]), [last]))
        long = np.minimum(here[cuts[1:] - 1] - here[cuts[:-1]], there[cuts[1:] - 1] - there[cuts[:-1]]) >= shortest - 1
        for i, j in zip(cuts[:-1][long].tolist(), cuts[1:][long].tolist()):
            yield np.arange(i, j)

    found = []
    tight = (steps > 1) | (moved != 1)
    for wide in pieces(0, len(here), (steps > GAP + 1) | (moved <= 0) | (moved > GAP + 1)):
        one = passage(wide)
        if one:
            found.append(one)
            continue
        # Too many edits on the whole: what is verbatim in it.
        found += filter(None, map(passage, pieces(int(wide[0]), int(wide[-1]) + 1, tight)))
    return found


_FOUND = (
    "rid long, hub long, start_word int, end_word int, match_start_word int, match_end_word int, similarity double"
)


def _verify(least: int, similarity: float):
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 64):
            out = []
            columns = zip(*(batch.column(n).to_pylist() for n in ("rid", "hub", "l", "hl", "mine", "theirs")))
            pairs = [x for x in columns if x[4] and x[5]]
            if not pairs:
                continue
            spans = [s for x in pairs for s in x[4:]]
            ends = np.cumsum([s.count(b" ") + 1 for s in spans])
            parts = np.split(shingles(spans), ends[:-1])
            for (rid, hub, l, hl, *_), mine, theirs in zip(pairs, parts[::2], parts[1::2]):
                mine, theirs = (x[: max(0, len(x) - WIDTH + 1)] for x in (mine, theirs))
                for s, e, t, u, alike in shared_passages(mine, theirs, least - WIDTH + 1, similarity):
                    out.append((rid, hub, l + s, l + e, hl + t, hl + u, alike))
            if out:
                kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def _stored(df: DataFrame, label: str) -> DataFrame:
    """As :func:`stored`. Spark drops the shuffle files of the write with its end, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, None)
    conf.set(_CLEAN_UP, "true")
    try:
        return stored(df, label)
    finally:
        conf.unset(_CLEAN_UP) if before is None else conf.set(_CLEAN_UP, before)


def _numbered(docs: DataFrame) -> DataFrame:
    make = add_columns(lambda batch, before: {"rid": pa.array(row_ids(batch.num_rows, before))})
    return docs.mapInArrow(make, schema_with(docs, rid="long"))


def duplicate_passages(
    docs: DataFrame, ids: str = "doc_id", text: str = "text", least: int = 50, similarity: float = 0.8, enough: int = ENOUGH
) -> DataFrame:
    """One row per passage that a document shares with an earlier one: ``doc_id``, ``start_word``, ``end_word`` (excluded), the same
    of the match, ``similarity``, and ``class_id``, the smallest id of all documents joined by passages.

    The first document of a group has one row too, without a match, from the first to the last word shared.
    """
    shortest = least - WIDTH + 1
    marked = stored(_numbered(docs.select(F.col(ids).alias("id"), F.col(text).alias("text"))), "numbered")
    windows = marked.select("rid", "text").mapInArrow(_windows(shortest), "key long, " + _LINK)
    dealt = windows.repartition("key").sortWithinPartitions("key", "hub", "rid", "at")
    links = _stored(dealt.mapInArrow(_link_windows(shortest), _LINK), "window-links")
    contested = links.filter("hub < 0").groupBy("rid").agg(F.collect_set(F.struct("at", "ext")).alias("windows"))
    again = _stored(contested, "contested").join(marked.select("rid", "text"), "rid").mapInArrow(_contested(shortest), "key long, rid long, at long")
    dealt = again.repartition("key").sortWithinPartitions("key", "rid", "at")
    pairs = links.filter("hub >= 0").unionByName(dealt.mapInArrow(_link_passages(shortest), _LINK))
    pairs = pairs.repartition("rid", "hub").sortWithinPartitions("rid", "hub")
    candidates = _stored(
        pairs.mapInArrow(_join_intervals(enough), "rid long, hub long, l int, r int, hl int, hr int"), "candidates"
    )
    # The words of both sides. Both joins take the same exchange of the texts, which has to read alike for that; AQE splits the rows of a frequent match.
    texts = marked.select("rid", "text")
    cut = candidates.withColumnRenamed("rid", "doc")
    for doc, first, last, out in (("doc", "l", "r", "mine"), ("hub", "hl", "hr", "theirs")):
        cut = cut.join(texts, F.col(doc) == F.col("rid")).drop("rid")
        cut = cut.mapInArrow(_cut("text", first, last, out), schema_with(cut, **{out: "binary", "text": "string"})).drop("text")
    both = cut.withColumnRenamed("doc", "rid")
    found = _stored(both.mapInArrow(_verify(least, similarity), _FOUND).distinct(), "passages")
    return _with_classes(found, marked.select("rid", "id"))


def _with_classes(found: DataFrame, ids: DataFrame) -> DataFrame:
    comps = stored(components(found.select("rid", "hub"), "rid", "hub"), "classes")
    roots = comps.select(F.col("component").alias("node"), "component").distinct()
    named = stored(comps.unionByName(roots).join(ids, F.col("node") == F.col("rid")).select("node", "component", "id"), "named")
    least = stored(named.groupBy("component").agg(F.min("id").alias("class_id")), "least")
    labels = stored(named.join(least, "component").select("node", "id", "class_id"), "labels")
    hubs = found.groupBy("hub").agg(F.min("match_start_word").alias("start_word"), F.max("match_end_word").alias("end_word"))
    first = hubs.join(found.select(F.col("rid").alias("hub")).distinct(), "hub", "left_anti").select(
        F.col("hub").alias("rid"),
        F.lit(None).cast("long").alias("hub"),
        "start_word",
        "end_word",
        F.lit(None).cast("int").alias("match_start_word"),
        F.lit(None).cast("int").alias("match_end_word"),
        F.lit(1.0).alias("similarity"),
    )
    rows = found.unionByName(stored(first, "firsts"))
    mine = rows.join(labels.select(F.col("node").alias("rid"), F.col("id").alias("doc_id"), "class_id"), "rid")
    match = labels.select(F.col("node").alias("hub"), F.col("id").alias("match_doc_id"))
    return mine.join(match, "hub", "left").select(
        "doc_id", "start_word", "end_word", "match_doc_id", "match_start_word", "match_end_word", "similarity", "class_id"
    )
