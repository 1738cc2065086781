"""Plain descriptions of what to replicate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession


def key_list(keys: str | Sequence[str]) -> list[str]:
    """A key is a column name, a comma separated list of names, or a sequence of names."""
    if isinstance(keys, str):
        keys = keys.split(",")
    names = [k.strip() for k in keys]
    if not names or not all(names):
        raise ValueError("a key needs at least one column name")
    return names


@dataclass(frozen=True)
class HighWaterMark:
    """Where the last extract ended, and which rows come after it.

    ``default`` is used when the target is missing or empty; ``None`` then means a full extract.
    No wall clock is read here: a caller that wants "a week ago" passes that moment.
    """

    column: str
    lookback: timedelta = timedelta(0)
    inclusive: bool = True
    default: datetime | None = None

    @classmethod
    def reread(cls, column: str, extra_days: int = 0, default: datetime | None = None) -> HighWaterMark:
        """Strict bound that re-reads one hour, and ``extra_days`` more, to catch late rows."""
        return cls(column, timedelta(hours=1 + 24 * extra_days), inclusive=False, default=default)


@dataclass(frozen=True)
class TableSpec:
    """One replicated table.

    ``extract(spark, since)`` returns the rows past ``since`` (a datetime, or None for everything).
    ``post_load`` is applied to the merged frame just before it is published.
    """

    name: str
    keys: str | Sequence[str] = ()
    mark: HighWaterMark | None = None
    extract: Callable[[SparkSession, datetime | None], DataFrame] | None = None
    post_load: Callable[[DataFrame], DataFrame] | None = None
    null_keys: str = "keep"
    ties: str = "one"
    tie_breakers: Sequence[str] | None = None

    @property
    def key_columns(self) -> list[str]:
        return key_list(self.keys)
