"""Records that an API hands out page by page, as Spark data sources.

The request itself is the caller's: an importable ``fetch`` function, named ``module:function``, that
takes a dict and returns one page as a dict. It runs in the executors; authentication, rate limits and
retries are its business. Pages come out as JSON text, to be given a schema and unwrapped by DataFrame
operators.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lakesync.operators.schema import fits_double
from lakesync.session import shared_dir

PAGE_SCHEMA = "resource string, position string, body string"


# Without these a read cannot know where it ends.
_REQUIRED = {
    "offset": ("total",),
    "count": ("pages",),
    "number": ("data_key", "page_size"),
    "ranges": ("until", "data_key", "time_key"),
}


def fetch_function(name: str) -> Callable[[dict], dict]:
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


class PageSlice(InputPartition):
    """A page to request or, with a successor rule, the first page of a chain."""

    def __init__(self, request: dict | None, end: int | None = None):
        self.request = request
        # Where the next range begins.
        self.end = end


def _record_count(page: dict, data_key: str | None) -> int:
    return len(page.get(data_key) or []) if data_key else 0


def _dig(page: dict, path: str) -> object:
    for step in path.split("."):
        page = page.get(step) if isinstance(page, dict) else None
    return page


def _has(page: dict, path: str) -> bool:
    *parents, last = path.split(".")
    place = _dig(page, ".".join(parents)) if parents else page
    return isinstance(place, dict) and last in place


def _seconds(moment: object) -> float:
    """An epoch from a number or from text in ISO form, UTC if it names no zone."""
    if isinstance(moment, (int, float)):
        return moment
    if not isinstance(moment, str):
        raise ValueError(f"a record without a time: {moment!r}")
    if moment.replace(".", "", 1).isdigit():
        return float(moment)
    told = datetime.fromisoformat(moment)
    return (told if told.tzinfo else told.replace(tzinfo=timezone.utc)).timestamp()


class PageReader(DataSourceReader):
    """Modes: ``offset`` and ``count`` know all pages and read them in parallel; ``number`` asks for
    pages until a short one, ``link`` follows the next link of each page, ``cursor`` continues from the
    end time of each page. A chain is one task by nature, holding one page at a time. ``ranges`` cuts the time up to ``until`` into
    ``ranges`` chains, one task each, and is cut finer where records are dense.
    """

    def __init__(self, options: dict[str, str]):
        self.fetch_name = options["fetch"]
        self.mode = options.get("mode", "offset")
        self.resource = options.get("resource", "")
        self.size = int(options.get("page_size", "1000"))
        self.total = int(options.get("total", "0"))
        self.pages = int(options.get("pages", "0"))
        self.data_key = options.get("data_key")
        self.next_key = options.get("next_key", "next_href")
        self.start = options.get("start", "0")
        self.until = options.get("until")
        self.ranges = int(options.get("ranges", "16"))
        self.time_key = options.get("time_key")
        if self.mode not in ("offset", "count", "number", "link", "cursor", "ranges"):
            raise ValueError(f"unknown paging mode: {self.mode}")
        absent = [o for o in _REQUIRED.get(self.mode, ()) if o not in options]
        if absent:
            raise ValueError(f"paging mode {self.mode} needs {', '.join(absent)}, or it would end too early")

    def partitions(self) -> Sequence[InputPartition]:
        if self.mode == "offset":
            return [PageSlice({"offset": i}) for i in range(0, max(self.total, 1), self.size)]
        if self.mode == "count":
            # A scan needs a partition, so one without a request stands for no pages.
            return [PageSlice({"page": i}) for i in range(1, self.pages + 1)] or [PageSlice(None)]
        if self.mode == "number":
            return [PageSlice({"page": 1})]
        if self.mode == "cursor":
            return [PageSlice({"start_time": self.start})]
        if self.mode == "ranges":
            return [PageSlice({"start_time": a}, b) for a, b in self._ranges()]
        return [PageSlice({})]

    def _ranges(self) -> list[tuple[int, int | None]]:
        """(begin, end) of the ranges; the last one is open, as a chain's end is.

        Half of them are equal parts of the time. A request at the begin of each tells how far its first page reaches, and so how many
        it may have; the one that may have most is halved until there are as many as wanted, or all have one page.
        """
        start, until = int(self.start), int(self.until)
        reach: dict[int, int | None] = {}

        def pages(a: int, b: int) -> float:
            if a not in reach:
                page = fetch_function(self.fetch_name)({"resource": self.resource, "start_time": a})
                following = self._following({"start_time": a}, page)
                reach[a] = int(following["start_time"]) if following else None
            return 1 if reach[a] is None or reach[a] >= b else (b - a) / max(reach[a] - a, 1)

        first = max(1, self.ranges // 2)
        cuts = sorted({start + max(until - start, 0) * i // first for i in range(first)})
        parts = {a: b for a, b in zip(cuts, [*cuts[1:], max(until, start + 1)])}
        while len(parts) < self.ranges:
            a = max(parts, key=lambda x: pages(x, parts[x]))
            if pages(a, parts[a]) <= 1 or parts[a] - a < 2:
                break
            middle = (a + parts[a]) // 2
            parts[middle], parts[a] = parts[a], middle
        ordered = sorted(parts)
        return list(zip(ordered, [*ordered[1:], None]))

    def _before(self, page: dict, end: int) -> dict:
        """A page without the records that the next range has as well: those at its begin or later."""
        kept = [r for r in page.get(self.data_key) or [] if _seconds(_dig(r, self.time_key)) < end]
        return {**page, self.data_key: kept}

    def _following(self, request: dict, page: dict) -> dict | None:
        if self.mode == "number":
            return {"page": request["page"] + 1} if _record_count(page, self.data_key) >= self.size else None
        if self.mode == "link":
            if not request and not _has(page, self.next_key):
                raise ValueError(f"the first page has no {self.next_key}: name the key of the next link as next_key")
            link = _dig(page, self.next_key)
            return {"next": link} if link else None
        if self.mode in ("cursor", "ranges"):
            end = page.get("end_time")
            full = page.get("count", self.size) >= self.size
            if end and str(end) == str(request["start_time"]):
                known = "count" in page or self.data_key
                count = page.get("count", _record_count(page, self.data_key))
                if not known:
                    raise ValueError(f"the cursor stays at {end}: a data_key must tell the last page from one too small for that second")
                if count >= self.size:
                    raise ValueError(f"more records at {end} than a page holds: the cursor cannot pass them")
                return None
            # The last of several ranges is open to the end, as one cursor without a bound is.
            done = not end or (self.mode == "cursor" and self.until and int(end) >= int(self.until))
            return {"start_time": end} if full and not done else None
        return None

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch = fetch_function(self.fetch_name)
        request = partition.request
        while request is not None:
            page = fetch({"resource": self.resource, **request})
            position = next(iter(request.values()), "first")
            following = self._following(request, page)
            if partition.end is not None:
                page = self._before(page, partition.end)
                if following and int(following["start_time"]) >= partition.end:
                    following = None
            yield self.resource, str(position), json.dumps(page)
            request = following


class PageStreamReader(DataSourceStreamReader):
    """A time cursor as a stream: the offset is the end time up to which records were taken.

    The chain of a batch is read in an executor; the driver only learns the newest end time, by a
    request with ``latest`` set.
    """

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.fetch_name = options["fetch"]
        self.resource = options.get("resource", "")

    def initialOffset(self) -> dict:
        return {"end_time": int(self.options.get("start", "0"))}

    def latestOffset(self) -> dict:
        page = fetch_function(self.fetch_name)({"resource": self.resource, "latest": True})
        return {"end_time": int(page["end_time"])}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start["end_time"] >= end["end_time"]:
            return []
        return [PageSlice({"start_time": start["end_time"], "until": end["end_time"]})]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        start, until = partition.request["start_time"], partition.request["until"]
        chain = PageReader({**self.options, "mode": "cursor", "until": str(until)})
        yield from chain.read(PageSlice({"start_time": start}))


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PageStreamReader(self.options)


def paged_source(spark: SparkSession, fetch: str, mode: str = "offset", **options: object) -> DataFrame:
    """Pages as ``resource, position, body``."""
    spark.dataSource.register(PageSource)
    texts = {k: str(v) for k, v in options.items() if v is not None}
    return spark.read.format("pages").options(fetch=fetch, mode=mode, **texts).load()


def cursor_source(spark: SparkSession, fetch: str, start: int = 0, **options: object) -> DataFrame:
    """All pages of a time cursor export since ``start``, the last one included."""
    return paged_source(spark, fetch, "cursor", start=start, **options)


def cursor_ranges(
    spark: SparkSession, fetch: str, start: int, until: int, data_key: str, time_key: str, ranges: int = 16, **options: object
) -> DataFrame:
    """The same export by ``ranges`` tasks, each with a part of the time from ``start`` to ``until``; the last goes on to the end.

    ``time_key`` is the time by which the export is ordered, in each record, as an epoch or ISO text: where two ranges
    meet, a page reaches over the border, and what lies behind it is left to the next range. Pages of one range may still share
    records at their ends, as those of one cursor do.
    """
    more = {"until": until, "data_key": data_key, "time_key": time_key, "ranges": ranges}
    return paged_source(spark, fetch, "ranges", start=start, **more, **options)


def cursor_stream(spark: SparkSession, fetch: str, start: int = 0, **options: object) -> DataFrame:
    """The same export as a stream."""
    spark.dataSource.register(PageSource)
    texts = {k: str(v) for k, v in options.items() if v is not None}
    return spark.readStream.format("pages").options(fetch=fetch, start=str(start), **texts).load()


def page_records(pages: DataFrame, data_key: str, record: str | T.StructType, strict: bool = True) -> DataFrame:
    """The records of JSON pages under a declared record schema, or ``string`` for raw JSON.

    A page that does not parse or has no list under ``data_key``, an error answer say, ends the job that reads
    the records. With ``strict=False`` such pages give none; :func:`bad_pages` shows them.
    """
    kind = record.simpleString() if isinstance(record, T.StructType) else record
    found = F.from_json("body", f"`{data_key}` array<{kind}>")[data_key]
    if strict:
        place = F.coalesce(F.col("position"), F.lit("?")) if "position" in pages.columns else F.lit("?")
        said = F.concat(F.lit(f"page without a list of {data_key}, at position "), place)
        found = F.when(found.isNull(), F.raise_error(said).cast(f"array<{kind}>")).otherwise(found)
    rows = pages.select(F.explode(found).alias("record"))
    return rows.select("record.*") if isinstance(rows.schema["record"].dataType, T.StructType) else rows


def discovered_schema(records: DataFrame, column: str = "record") -> T.StructType:
    """The fields that occur in a column of JSON objects (variants), with types that hold all their values.

    One aggregate merges the shapes of all records. A field with values of several kinds is text, as is one without any; lists and
    objects become JSON text. Numbers with and without exponents are double where a double keeps the digits of all of them, else text.
    """
    told = records.agg(F.schema_of_variant_agg(column).alias("shape")).first()["shape"]
    if told in (None, "VOID"):
        return T.StructType()
    if not told.startswith("OBJECT<"):
        raise ValueError(f"records are no objects: {told[:100]}")
    shape = T._parse_datatype_string(told.replace("OBJECT<", "STRUCT<"))
    doubles = [f.name for f in shape.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    safe: dict[str, bool] = {}
    if doubles:
        fit = [F.bool_and(fits_double(_field(column, n, "string"))).alias(f"d{i}") for i, n in enumerate(doubles)]
        safe = dict(zip(doubles, records.agg(*fit).first()))
    fields = []
    for f in shape.fields:
        scalar = isinstance(f.dataType, (T.StringType, T.BooleanType, T.IntegralType, T.DecimalType))
        kept = scalar or safe.get(f.name)
        fields.append(T.StructField(f.name, f.dataType if kept else T.StringType()))
    return T.StructType(fields)


def _field(column: str, name: str, kind: str) -> Column:
    if '"' not in name:
        return F.try_variant_get(column, f'$["{name}"]', kind)
    # A path has no way to write such a name.
    return F.try_variant_get(F.try_element_at(F.col(column).cast("map<string,variant>"), F.lit(name)), "$", kind)


def discovered_records(pages: DataFrame, data_key: str) -> DataFrame:
    """The records of JSON pages with every field that any of them has, in the types of :func:`discovered_schema`.

    Pages are parsed once: their records are written to shared storage, and shapes and fields are read from there.
    """
    folder = shared_dir(pages.sparkSession, f"records-{data_key}")
    page_records(pages, data_key, "variant").write.parquet(folder)
    records = pages.sparkSession.read.schema("record variant").parquet(folder)
    schema = discovered_schema(records)
    return records.select(*[_field("record", f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def bad_pages(pages: DataFrame, data_key: str) -> DataFrame:
    """The pages that :func:`page_records` refuses."""
    return pages.filter(F.from_json("body", f"`{data_key}` array<string>")[data_key].isNull())


def id_fanout(
    ids: DataFrame, column: str, fetch: str, resource: str = "", tasks: int | None = None
) -> DataFrame:
    """One request per distinct id, spread over ``tasks`` tasks: ``id, body``.

    By default there are as many tasks as shuffle partitions; ids are small, and would be merged into one task otherwise.
    """
    wanted = ids.select(F.col(column).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
    tasks = tasks or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = wanted.repartition(tasks, "id")

    def request_all(batches):
        get = fetch_function(fetch)
        for batch in batches:
            # A few bodies at a time: a whole batch of them may not fit.
            for at in range(0, len(batch), 32):
                some = batch.iloc[at : at + 32]
                yield some.assign(body=[json.dumps(get({"resource": resource, "id": i})) for i in some["id"]])

    return spread.mapInPandas(request_all, "id string, body string")
