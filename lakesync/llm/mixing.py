"""Mixing sources to target weights by Poisson replication.

A source with n documents and target weight w (weights are taken relative to their sum) gets the mean repetition rate
w * total / n, so that the expected number of its copies is w * total. Each document's count is the inverse of the Poisson
distribution with that mean at a uniform number hashed from the seed and the document. It is then repeated so often, and
all copies are put in the order of a second hash, dealt to partitions in one exchange. A rate above ``PIECE`` is cut into equal
pieces, each with its own number, whose counts add up; the distribution is the same and its tables stay short.

The same seed gives the same copies and order on any cluster. A document is told by its id, or by its text's MD5 when the id is
null; rows alike in that are repeated alike. Null is a source of its own. A source without weight, or with weight zero or less,
gets no copies; ``total`` is the number of documents when none is given. An empty table gives an empty table. Input columns
with the name of an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 32.0
# Beyond this count a piece's share is below the last place of a double.
LONGEST = 160


def uniform(*parts: Column | str) -> Column:
    """52 bits of the MD5 of ``parts``, as a number from 0 up to 1."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def tempered_weights(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """(source, weight): document counts to a power below one, which lifts small sources."""
    return docs.groupBy(source).agg(F.pow(F.count("*").cast("double"), F.lit(power)).alias("weight"))


def repetition_rates(docs: DataFrame, weights: DataFrame, source: str = "source", total: float | None = None) -> DataFrame:
    """(source, pieces, cdf): into how many pieces its rate is cut, and the distribution of one piece."""
    counts = docs.groupBy(F.col(source).alias("__name")).agg(F.count("*").alias("n"))
    given = weights.filter("weight > 0").select(F.col(source).alias("__source"), "weight")
    both = counts.join(given, F.col("__name").eqNullSafe(F.col("__source")))
    weight_sum = both.agg(F.sum("weight")).first()[0]
    if weight_sum is None:
        return both.select("__name", F.lit(1).alias("pieces"), F.array(F.lit(1.0)).alias("cdf")).limit(0)
    wanted = float(docs.count() if total is None else total)
    rate = F.col("weight") / F.lit(weight_sum) * F.lit(wanted) / F.col("n")
    pieces = F.greatest(F.ceil(rate / F.lit(PIECE)), F.lit(1)).cast("int")
    cut = both.select("__name", pieces.alias("pieces"), (rate / pieces).alias("mean"))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(LONGEST)),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf")),
        lambda s, i: F.struct(
            (s["p"] * F.col("mean") / i).alias("p"),
            F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * F.col("mean") / i)).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    return cut.select("__name", "pieces", terms.alias("cdf"))


def replicate_to_weights(
    docs: DataFrame,
    weights: DataFrame | None = None,
    source: str = "source",
    ids: str = "doc_id",
    text: str = "text",
    seed: str = "mix",
    total: float | None = None,
) -> DataFrame:
    """``docs`` repeated to ``weights`` (tempered counts if None), with ``copy`` from 1 and ``order_key``, in that order."""
    rates = repetition_rates(docs, tempered_weights(docs, source) if weights is None else weights, source, total)
    identity = F.coalesce(F.col(ids).cast("string"), F.md5(F.col(text).cast("binary")), F.lit(""))
    kept = docs.drop("copy", "order_key").withColumn("__id", identity)
    # One digest for each piece, outside the comparison with the distribution's entries.
    draws = F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda i: uniform(F.lit(seed), i.cast("string"), "__id"))
    drawn = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    # Left to Spark: a few sources are broadcast by measured size, many are joined by a shuffle that AQE splits.
    counted = kept.join(rates, kept[source].eqNullSafe(rates["__name"])).withColumn("__n", drawn)
    copies = counted.filter("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    place = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("copy").cast("string"), "__id"))
    keyed = copies.withColumn("order_key", F.conv(F.substring(place, 1, 13), 16, 10).cast("long"))
    # The key is uniform, so equal ranges of it are equal partitions, and no sampling pass is needed.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.floor(F.col("order_key").cast("double") / F.lit(float(1 << 52)) * parts).cast("int")
    dealt = keyed.drop("__id", "__name", "pieces", "cdf", "__n").repartitionById(parts, at)
    return dealt.sortWithinPartitions("order_key", ids, "copy")


MIX_SQL = """
    WITH counts AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5::DOUBLE) AS weight FROM documents GROUP BY source),
    rates AS (SELECT source, weight / (SELECT sum(weight) FROM counts) * (SELECT sum(n)::DOUBLE FROM counts) / n AS rate FROM counts),
    cut AS (SELECT source, greatest(ceil(rate / 32.0), 1)::INTEGER AS pieces, rate / greatest(ceil(rate / 32.0), 1) AS mean FROM rates),
    terms AS (
        WITH RECURSIVE t(source, pieces, mean, i, p, c) AS (
            SELECT source, pieces, mean, 0, exp(-mean), exp(-mean) FROM cut
            UNION ALL SELECT source, pieces, mean, i + 1, p * mean / (i + 1), c + p * mean / (i + 1) FROM t WHERE i < 160)
        SELECT source, pieces, list(c ORDER BY i) AS cdf FROM t GROUP BY source, pieces),
    drawn AS (
        SELECT d.doc_id, d.source, coalesce(d.doc_id::VARCHAR, md5(d.text), '') AS id,
               list_sum([len(list_filter(t.cdf, lambda c: c <= ('0x' || substr(md5('mix|' || i || '|' || coalesce(d.doc_id::VARCHAR, md5(d.text), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE))
                         for i in range(1, t.pieces + 1)]) AS n
        FROM documents d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, source, copy::INTEGER AS copy, ('0x' || substr(md5('mix|order|' || copy || '|' || id), 1, 13))::BIGINT AS order_key
    FROM drawn, unnest(range(1, n::BIGINT + 1)) AS u(copy)"""
