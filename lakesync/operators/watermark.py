"""High-water marks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.functions.text import to_epoch, to_second
from lakesync.spec import HighWaterMark


def high_water_mark(df: DataFrame, mark: HighWaterMark) -> DataFrame:
    """One row: ``high_water``, cut to the second and moved back by the lookback, and its epoch.

    Text timestamps are converted before the maximum is taken; text that is none is passed over.
    """
    seconds = int(mark.lookback.total_seconds())
    newest = F.max(F.col(mark.column).try_cast("timestamp_ntz"))
    moved = to_second(F.col("newest")) - F.make_dt_interval(secs=F.lit(seconds))
    row = df.agg(newest.alias("newest")).select(moved.alias("high_water"))
    return row.select("high_water", to_epoch(F.col("high_water")).alias("epoch"))


def read_high_water_mark(df: DataFrame, mark: HighWaterMark) -> datetime | None:
    """The mark's value, the only row that reaches the driver; the default for an empty target."""
    value = high_water_mark(df, mark).first()["high_water"]
    return mark.default if value is None else value


def since_high_water(df: DataFrame, mark: HighWaterMark, value: datetime | Column | None) -> DataFrame:
    """Rows past the mark; all rows without one. A literal bound is pushed into the scan."""
    if value is None:
        return df
    # Built from text, so that the driver's own time zone plays no part.
    bound = value if isinstance(value, Column) else F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    ts = F.col(mark.column)
    if df.schema[mark.column].dataType.typeName() == "string":
        ts = ts.try_cast("timestamp_ntz")
    return df.filter(ts >= bound if mark.inclusive else ts > bound)
