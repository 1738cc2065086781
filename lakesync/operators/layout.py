"""Physical layout of written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakesync.spec import key_list


def choose_layout_key(columns: Sequence[str], primary_keys: Sequence[str] = ()) -> str:
    """Distribution and sort key: the first key column, or the first column of a table without key."""
    return primary_keys[0] if primary_keys else columns[0]


def clustered_layout(df: DataFrame, keys: str | Sequence[str], sort_keys: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of one key together and files sorted, so scans skip by min/max statistics.

    Distribution is on the first key. The rebalance hint lets Spark split the files of a hot key
    and merge small ones at run time; a plain repartition would put a hot key in a single file.
    """
    keys = key_list(keys)
    order = key_list(sort_keys) if sort_keys else keys
    return df.hint("rebalance", keys[0]).sortWithinPartitions(*order)
