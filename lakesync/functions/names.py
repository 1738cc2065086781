"""Column name rules. Names are metadata, so these run on the driver."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks removed from a question when it becomes a column name.
QUESTION_MARKS = "?:'\")(!./\\"


def sheet_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("/", "_")


def column_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def question_name(text: str) -> str:
    kept = text.lower().replace(" ", "_").translate({ord(mark): None for mark in QUESTION_MARKS})
    return kept.encode("ascii", "ignore").decode()


def undotted_name(name: str) -> str:
    return name.replace(".", "_")


def collisions(names: Iterable[str]) -> list[str]:
    """Names that occur more than once, compared the way Spark resolves them."""
    counts = Counter(n.lower() for n in names)
    return sorted(n for n, times in counts.items() if times > 1)


def normalize_names(df: DataFrame, rule: Callable[[str], str] = sheet_name) -> DataFrame:
    """Rename every column by a rule; two columns must not end up with one name."""
    names = [rule(c) for c in df.columns]
    if doubled := collisions(names):
        raise ValueError(f"columns collide after renaming: {', '.join(doubled)}")
    return df.toDF(*names)


def question_names(df: DataFrame, questions: dict[str, str]) -> DataFrame:
    """Rename answer columns from question id to cleaned question text."""
    if unknown := [c for c in df.columns if c not in questions]:
        raise ValueError(f"no question for columns: {', '.join(unknown)}")
    return normalize_names(df, lambda c: question_name(questions[c]))


def question_text(c: Column) -> Column:
    """The question rule as an expression, for question texts held in a table."""
    spaced = F.replace(F.lower(c), F.lit(" "), F.lit("_"))
    return F.regexp_replace(F.translate(spaced, QUESTION_MARKS, ""), r"[^\x00-\x7F]", "")
