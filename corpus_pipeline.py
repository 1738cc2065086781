"""A training corpus from raw documents: languages told, near copies removed, personal data replaced, sources mixed, texts packed.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; each result is written and
read again. All stages but the last return the columns of documents. Copies that the mixing makes keep their document's id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm import language_id, mixing, packing, pii, simhash
from lakesync.llm.common import stored, table
from lakesync.llm.queries import SURROGATE_KEY, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# No SQL states learned languages, SimHash components, or a public tokenizer's ids.
ORACLE_SQL = None


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told, labelled with it; those without letters, or between two languages, go."""
    found = language_id.identify(docs, language_id.fit(docs))
    return found.filter(~language_id.is_ambiguous()).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; ``n_chars`` counts the new text."""
    return pii.replace_pii(docs, SURROGATE_KEY).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh as the square root of their size, in one global random order."""
    return mixing.replicate_to_weights(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids."""
    pieces = packing.pack(docs.select("doc_id", "text"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", tell_language),
    ("near copies", drop_near_copies),
    ("personal data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
