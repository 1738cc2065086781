"""Near-duplicate texts by SimHash: deletion-variant signatures find all fingerprints a few bits apart.

A fingerprint of 64 bits is cut into (bits + 2) // 2 segments, the fewest for which two fingerprints that differ in at most
``bits`` places must have a segment that differs in at most one. Each segment is indexed once for each of its places,
with that place blanked: two segments at most one bit apart share such a variant. An equality shuffle on variants brings
candidates together, and each is verified on all 64 bits.

Equal fingerprints are one row before the index is built, so copies never meet each other there. The fingerprints
that share a variant give a spanning forest of their verified links, never all pairs.

``keep_one`` looks further: near copies at a Jaccard similarity of 0.8 differ in about ten of 64 bits, more than any few segments
find. It takes 128 bits, two SimHashes of the distinct shingles of five words, and links at ``NEAR`` or fewer differing bits.
Eleven segments, one across both numbers, find every such pair, by the same rule. They have 11 or 12 bits each, so a variant is shared by
many: the index is linear, the comparisons grow with the square of the distinct fingerprints.

Nulls, empty texts and texts without words have fingerprint zero and link like any other. Rows with a null id have
fingerprint and component; a component's id is its smallest non-null id, null if it has none. Repeated rows are kept.
Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import add_columns, components, lowest_labels, row_ids, schema_with, shingle_hashes, stored

_BIT_SUMS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_PLACES = np.arange(8, dtype=np.int64) * 256
# Rows whose runs of equal variants are linked at a time, and the longest run that is compared pair by pair.
_BLOCK = 1 << 17
_SHORT = 48
# Pairs of a long run that are compared at a time.
_CELLS = 1 << 17
# Of 128 bits: the expected difference of two sets of one size at a Jaccard similarity of 0.8 is 19.4.
NEAR = 20
_WIDE = ("lo", "hi")


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of ``hashes``."""
    ones = np.zeros((8, 256), np.int64)
    for i in range(0, len(hashes), 1 << 16):
        octets = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.bincount((octets + _BYTE_PLACES).ravel(), minlength=2048).reshape(8, 256)
    bits = (ones @ _BIT_SUMS).ravel() * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, width: int = 4) -> int:
    """Bits set in over half of the text's shingle hashes; zero without words."""
    return _majority(shingle_hashes(text, width))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Other 64 bits of each hash (the finalizer of SplitMix64)."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(text: str | None, width: int = 5) -> tuple[int, int]:
    """128 bits, as two numbers, of the text's distinct shingles; zeros without words."""
    hashes = np.unique(shingle_hashes(text, width))
    return _majority(hashes), _majority(_mixed(hashes))


def with_fingerprints(docs: DataFrame, text: str = "text", width: int = 4) -> DataFrame:
    """``docs`` with ``simhash`` (long) and ``row_id``, a number of the row that is fixed once this is stored."""

    def make(batch: pa.RecordBatch, before: int) -> dict[str, pa.Array]:
        prints = np.array([fingerprint(t, width) for t in batch.column(text).to_pylist()], np.uint64)
        return {"simhash": pa.array(prints.view(np.int64)), "row_id": pa.array(row_ids(len(prints), before))}

    kept = docs.drop("simhash", "row_id")
    return kept.mapInArrow(add_columns(make), schema_with(kept, simhash="long", row_id="long"))


def segments(bits: int, places: int = 64) -> list[tuple[int, int]]:
    """(lowest place, length) of each segment of a fingerprint of ``places`` bits."""
    count = (bits + 2) // 2
    cuts = [places * i // count for i in range(count + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def variants(parts: Sequence[Column], bits: int) -> Column:
    """One signature for each place of a fingerprint of one or two numbers: its segment without that place, under the place's number."""
    out = []
    for lo, length in segments(bits, 64 * len(parts)):
        part, shift = divmod(lo, 64)
        segment = F.shiftrightunsigned(parts[part], shift)
        if shift + length > 64:  # the rest is in the next number
            segment = segment.bitwiseOR(F.shiftleft(parts[part + 1], 64 - shift))
        segment = segment.bitwiseAND(F.lit((1 << length) - 1).cast("long"))
        for place in range(length):
            blanked = segment.bitwiseAND(F.lit(~(1 << place)).cast("long"))
            at = lo + place
            out.append(F.xxhash64(F.lit(at), blanked) if length > 56 else F.lit(at << 56).cast("long").bitwiseOR(blanked))
    return F.array(*out)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, each a row of 64-bit numbers."""
    return np.bitwise_count(a ^ b).sum(axis=-1)


def _with_neighbours(fp: np.ndarray, bits: int) -> np.ndarray:
    """Whether each row has another one at most ``bits`` places apart: all pairs, a bounded block of them at a time."""
    columns = [np.ascontiguousarray(c) for c in fp.T]
    found = np.zeros(len(fp), bool)
    step = max(1, _CELLS // max(len(fp), 1))
    for i in range(0, len(fp), step):
        apart = sum(np.bitwise_count(c[i : i + step, None] ^ c[None, i:]) for c in columns)
        near = apart <= bits
        np.fill_diagonal(near, False)
        if near.any():
            found[i : i + step] |= near.any(axis=1)
            found[i:] |= near.any(axis=0)
    return found


def _short_links(sig: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest over all runs of equal ``sig``, by comparing each row with the following ones of its run."""
    near_a, near_b = [], []
    here = np.arange(len(sig))
    for step in range(1, _SHORT):
        here = here[: np.searchsorted(here, len(sig) - step)]
        here = here[sig[here] == sig[here + step]]
        if not len(here):
            break
        near = here[_apart(fp[here], fp[here + step]) <= bits]
        near_a.append(near)
        near_b.append(near + step)
    if not near_a:
        return fp[:0], fp[:0]
    a, b = np.concatenate(near_a), np.concatenate(near_b)
    used, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    if not len(used):
        return fp[:0], fp[:0]
    label = lowest_labels(at[: len(a)], at[len(a) :], len(used))
    hub = label != np.arange(len(used))
    return fp[used[hub]], fp[used[label[hub]]]


def _long_links(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest over one run, in memory linear in its length: each row found takes its neighbours out of the rest."""
    a, b = [], []
    left = fp[_with_neighbours(fp, bits)]
    while len(left):
        hub, left = left[0], left[1:]
        waiting = [hub]
        while waiting and len(left):
            near = _apart(left, waiting.pop()) <= bits
            if near.any():
                found, left = left[near], left[~near]
                a.append(found)
                b.append(np.repeat(hub[None], len(found), axis=0))
                waiting.extend(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _linker(bits: int, parts: tuple[str, ...]):
    def complete(sig: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cuts = np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1, [len(sig)]))
        lengths = np.diff(cuts)
        short = np.repeat((lengths > 1) & (lengths <= _SHORT), lengths)
        yield _short_links(sig[short], fp[short], bits)
        for i in np.flatnonzero(lengths > _SHORT):
            yield _long_links(fp[cuts[i] : cuts[i + 1]], bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, fps, held = [], [], 0

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sigs, fps, held
            if not held:
                return
            sig, fp = np.concatenate(sigs), np.concatenate(fps)
            end = len(sig) if whole else int(np.searchsorted(sig, sig[-1]))
            for a, b in complete(sig[:end], fp[:end]):
                if len(a):
                    sides = {f"{side}_{p}": x[:, i] for side, x in (("a", a), ("b", b)) for i, p in enumerate(parts)}
                    yield pa.RecordBatch.from_pydict({n: pa.array(x.astype(np.int64)) for n, x in sides.items()})
            sigs, fps, held = [sig[end:]], [fp[end:]], len(sig) - end

        target = _BLOCK
        for batch in batches:
            sigs.append(batch.column("sig").to_numpy())
            fps.append(np.stack([batch.column(p).to_numpy().view(np.uint64) for p in parts], axis=1))
            held += batch.num_rows
            if held >= target:
                yield from flush(False)
                target = max(_BLOCK, 2 * held)  # a long run is looked at again only when it has doubled
        yield from flush(True)

    return run


def _linked(signed: DataFrame, bits: int, parts: tuple[str, ...]) -> DataFrame:
    """Forests of the rows (sig, parts) that share ``sig``, with the parts of both ends."""
    dealt = signed.repartition("sig").sortWithinPartitions("sig")
    schema = ", ".join(f"{side}_{p} long" for side in "ab" for p in parts)
    return dealt.mapInArrow(_linker(bits, parts), schema).distinct()


def links(prints: DataFrame, bits: int = 4) -> DataFrame:
    """(a, b): a forest over the distinct ``fp`` of ``prints`` that joins all that differ in at most ``bits`` places."""
    signed = prints.select("fp", F.explode(variants([F.col("fp")], bits)).alias("sig"))
    return _linked(signed.select("sig", "fp"), bits, ("fp",)).toDF("a", "b")


def wide_links(prints: DataFrame, bits: int = NEAR) -> DataFrame:
    """(a, b), numbers ``node`` of the distinct ``lo``, ``hi`` of ``prints`` (stored): a forest that joins all that differ in at most ``bits`` places."""
    signed = prints.select(F.explode(variants([F.col(p) for p in _WIDE], bits)).alias("sig"), *_WIDE)
    found = _linked(signed, bits, _WIDE)
    for side in "ab":
        ends = prints.select(F.col("node").alias(side), *[F.col(p).alias(f"{side}_{p}") for p in _WIDE])
        found = found.join(ends, [f"{side}_{p}" for p in _WIDE])
    return found.select("a", "b")


def fingerprint_components(marked: DataFrame, ids: str = "doc_id", bits: int = 4) -> DataFrame:
    """(simhash, component, component_id) for every fingerprint of ``marked``, a stored frame with ids and ``simhash``.

    ``component`` is a fingerprint of the class, and tells classes apart that have no id.
    """
    prints = stored(marked.groupBy(F.col("simhash").alias("fp")).agg(F.min(ids).alias("first_id")), "prints")
    comps = components(links(prints, bits))
    labelled = prints.join(comps, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    labelled = stored(labelled, "labelled")
    least = stored(labelled.groupBy("component").agg(F.min("first_id").alias("component_id")), "classes")
    members = labelled.join(least, "component").select(F.col("fp").alias("simhash"), "component", "component_id")
    return stored(members, "members")


def near_duplicates(docs: DataFrame, ids: str = "doc_id", text: str = "text", width: int = 4, bits: int = 4) -> DataFrame:
    """(ids, fingerprint, component_id) of every row of ``docs``."""
    marked = stored(with_fingerprints(docs.select(ids, text), text, width).drop(text), "marked")
    out = marked.join(fingerprint_components(marked, ids, bits), "simhash")
    return out.select(ids, F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, ids: str = "doc_id", text: str = "text", width: int = 5, bits: int = NEAR) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id (a null id last, then the first stored), whole.

    Groups are joined by links of 128-bit fingerprints over distinct shingles of ``width`` words; texts are not compared.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")

    def make(batch: pa.RecordBatch, before: int) -> dict[str, pa.Array]:
        texts = pc.struct_field(batch.column("row"), docs_text).to_pylist()
        prints = np.array([wide_fingerprint(t, width) for t in texts], np.uint64).reshape(-1, 2).view(np.int64)
        return {"lo": pa.array(prints[:, 0]), "hi": pa.array(prints[:, 1]), "row_id": pa.array(row_ids(len(prints), before))}

    docs_text = [docs.columns.index(text)]
    whole = docs.select(row)
    schema = schema_with(whole, lo="long", hi="long", row_id="long")
    marked = stored(whole.mapInArrow(add_columns(make), schema), "marked")
    first = F.min(F.struct(F.col(f"row.`{ids}`").isNull().alias("n"), F.col(f"row.`{ids}`").alias("i"), F.col("row_id").alias("r")))
    by_print = marked.groupBy(*_WIDE).agg(first.alias("first")).withColumn("node", F.monotonically_increasing_id())
    prints = stored(by_print, "prints")
    classes = prints.join(components(wide_links(prints, bits)), "node", "left")
    chosen = classes.groupBy(F.coalesce("component", "node").alias("class")).agg(F.min("first").alias("first"))
    return marked.join(chosen.select(F.col("first.r").alias("row_id")), "row_id", "left_semi").select("row.*")
