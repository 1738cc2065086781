"""Tables of distinct rows that grow by what is new, without being rewritten.

With every folder of such a table goes a Bloom filter of its rows' hashes, kept as a small table: a row's hash names a word of 64 bits and a
second hash sets four bits in it, at about four rows to a word. A delta is looked up there first. Only rows that a folder may hold, a few of a
thousand and the true repeats, are compared with that folder's rows; folders without any are not opened. So what is written
and exchanged is the delta and 16 bytes per word, not the target.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.operators.merge import distinct_rows
from lakesync.operators.schema import conformed
from lakesync.plans.manifest import Conflict, Version, continued
from lakesync.plans.publish import SnapshotStore
from lakesync.session import shared_dir

ROWS_PER_WORD = 4
_HASH, _BITS, _FOLDER, _WORDS, _WORD = "__hash", "__bits", "__folder", "__words", "__word"


def _place(h: Column, shift: int) -> Column:
    """A word with one bit set, named by six bits of a hash."""
    at = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def _hashed(df: DataFrame) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in df.columns]
    second = F.xxhash64(F.lit(1), *columns)
    bits = reduce(lambda a, b: a.bitwiseOR(b), [_place(second, shift) for shift in (0, 6, 12, 18)])
    return df.withColumns({_HASH: F.xxhash64(*columns), _BITS: bits})


def _word(words: Column) -> Column:
    # The number of words is a power of two.
    return F.col(_HASH).bitwiseAND(words - 1)


def write_filter(store: SnapshotStore, table: str, folder: str, schema: Any) -> dict[str, Any]:
    """Write the filter of a folder's rows; its place and size, to be kept with the version."""
    rows = store.spark.read.schema(schema).parquet(folder)
    words = 1
    while words * ROWS_PER_WORD < rows.count():
        words *= 2
    path = f"{store.root}/{table}/sums={uuid.uuid4().hex}"
    hashed = _hashed(rows).select(_word(F.lit(words).cast("bigint")).alias(_WORD), _BITS)
    hashed.groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS)).write.parquet(path)
    return {"sums": path, "words": words, "distinct": True}


def possible_repeats(store: SnapshotStore, hashed: DataFrame, facts: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """(hash, folder's number among ``facts``) of the rows that the filters do not rule out."""
    spark = store.spark
    sizes = sorted({told["words"] for told in facts.values()})
    filters = []
    for size in sizes:
        mine = [(i, told["sums"]) for i, told in enumerate(facts.values()) if told["words"] == size]
        read = spark.read.schema(f"{_WORD} bigint, {_BITS} bigint").parquet(*[p for _, p in mine])
        names = F.create_map(*[F.lit(x) for i, p in mine for x in (p.rsplit("=", 1)[1], i)])
        name = F.regexp_extract("_metadata.file_path", r"sums=([0-9a-f]{32})", 1)
        filters.append(read.select(F.lit(size).cast("bigint").alias(_WORDS), _WORD, F.col(_BITS).alias("set"), F.element_at(names, name).alias(_FOLDER)))
    every = reduce(DataFrame.unionByName, filters)
    asked = hashed.select(_HASH, _BITS, F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias(_WORDS))
    asked = asked.withColumn(_WORD, _word(F.col(_WORDS)))
    met = asked.join(every, [_WORDS, _WORD]).filter(F.col("set").bitwiseAND(F.col(_BITS)) == F.col(_BITS))
    return met.select(_HASH, _FOLDER).distinct()


def _not_in(store: SnapshotStore, rows: DataFrame, facts: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """The stored, distinct ``rows`` that are in none of the folders that ``facts`` names."""
    folder = shared_dir(store.spark, "repeats")
    hashed = _hashed(rows)
    possible_repeats(store, hashed, facts).write.parquet(folder)
    maybe = store.spark.read.schema(f"{_HASH} bigint, {_FOLDER} int").parquet(folder)
    numbers = sorted(r[0] for r in maybe.select(_FOLDER).distinct().collect())
    if not numbers:
        return rows
    held = store.spark.read.schema(rows.schema).parquet(*[list(facts)[i] for i in numbers])
    repeats = _repeats(hashed, maybe, held)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate(rows.columns)]
    return hashed.join(repeats, reduce(and_, same, F.col(_HASH) == F.col("__r")), "left_anti").select(*rows.columns)


def _repeats(hashed: DataFrame, maybe: DataFrame, held: DataFrame) -> DataFrame:
    """The rows of ``held`` that are among those rows of ``hashed`` whose hashes ``maybe`` names."""
    columns = held.columns
    suspects = hashed.join(maybe.select(_HASH).distinct(), _HASH, "left_semi").drop(_BITS)
    suspects = suspects.withColumnsRenamed({c: f"__s{i}" for i, c in enumerate(columns)} | {_HASH: "__s"})
    # Hashes bring rows together, all columns decide. The suspects are the small side, which Spark broadcasts when it is.
    equal = [F.col(f"`{c}`").eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(columns)]
    found = _hashed(held).drop(_BITS).join(suspects, reduce(and_, equal, F.col(_HASH) == F.col("__s")))
    return found.select(*[F.col(f"`{c}`").alias(f"__r{i}") for i, c in enumerate(columns)], F.col(_HASH).alias("__r")).distinct()


def append_distinct(store: SnapshotStore, table: str, df: DataFrame, load: Mapping[str, Any] | None = None) -> int:
    """Add the rows of ``df`` that the table does not hold; returns how many.

    The table then holds each row once. Where its rows are not known to be distinct, the first call rewrites it; later ones write new rows only. Maps
    and variants become JSON text, as in :func:`distinct_rows`. Appends side by side look at each other's rows before they are entered.
    """
    spark = store.spark
    before = store.table_state(table).current
    fresh = distinct_rows(df)
    if before is None or not _is_distinct(before):
        return _rewritten(store, table, df, before, load)
    schema = store.read_version(before).schema
    landing = shared_dir(spark, f"distinct-{table}")
    conformed(fresh, schema).write.parquet(landing)
    delta = spark.read.schema(schema).parquet(landing)
    while True:
        facts = {p: told if "sums" in (told := before.facts.get(p, {})) else write_filter(store, table, p, schema) for p in before.paths}
        new = _not_in(store, delta, facts)
        path = store.stage(table, new)
        count = spark.read.schema(schema).parquet(path).count()
        mine = {path: write_filter(store, table, path, schema)} if count else {}

        def build(state: Any, on: Version = before, facts: dict = facts, mine: dict = mine) -> list[dict[str, Any]]:
            current = state.table(table).current
            if current is None or current.seq != on.seq:
                raise Conflict(f"{table} was published anew meanwhile")
            audit = [{"kind": "load", **load}] if load else []
            return [continued(table, on, paths=[*on.paths, *mine], facts=facts | mine), *audit]

        try:
            store.manifest.publish(build)
            if not count:
                store.discard(path)
            return count
        except Conflict:
            store.discard(path)
            before = store.table_state(table).current
            if before is None or not _is_distinct(before) or store.read_version(before).schema != schema:
                return append_distinct(store, table, df, load)


def _is_distinct(version: Version) -> bool:
    return all(version.facts.get(p, {}).get("distinct") for p in version.paths)


def replace_distinct(
    store: SnapshotStore, table: str, df: DataFrame, built_on: Version | None, load: Mapping[str, Any] | None = None
) -> str:
    """A new copy of the table that holds each row of ``df`` once; :class:`Conflict` if ``built_on`` is no longer current."""
    rows = distinct_rows(df)
    path = store.stage(table, rows)
    on = {table: built_on.seq if built_on else 0}
    try:
        store.switch({table: path}, {table: rows.schema}, on, {path: {"distinct": True}}, [load] if load else [])
    except Conflict:
        store.discard(path)
        raise
    return path


def _rewritten(store: SnapshotStore, table: str, df: DataFrame, before: Version | None, load: Mapping[str, Any] | None) -> int:
    held, rows = 0, df
    if before is not None:
        base = store.read_version(before)
        held = base.count()
        rows = base.unionByName(conformed(df, base.schema))
    try:
        path = replace_distinct(store, table, rows, before, load)
    except Conflict:
        return append_distinct(store, table, df, load)
    return store.spark.read.parquet(path).count() - held
