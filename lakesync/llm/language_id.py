"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit, a binary classifier over hashed character n-grams tells the
languages whose bit is one from the others: a naive Bayes log-odds for every n-gram, from counts over all training texts. A text
gives each bit a margin, the mean log-odds of its n-grams; the loss of a language is the sum over bits of log(1 + exp(-margin
times the sign its codeword has there)), and the language with the least loss is predicted.

Training counts are added up inside each task, then by key, and turned into log-odds by groups of buckets. The driver gets a total for each
language, and a table of ``BUCKETS`` weights per bit, of which there are some ten times log2 of the languages; nothing there grows with the texts.

A text that is null or has no letter (superscripts, fractions and numerals are none) is ``und`` with score 0. Texts of any length are read whole. Training rows without a language or
without a letter teach nothing; without any training row, every text is ``und``. Ties between languages go to the name
that sorts first. Repeated rows count as often as they occur. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import add_columns, schema_with, small, stored

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
# A task hands on its counts when it holds this many languages, and begins anew.
HELD_LANGUAGES = 256
_GROUPS = 64
# Up to this many languages the code has every way to split them in two; beyond, this many times log2 random splits.
EXHAUSTIVE = 6
RANDOM_BITS = 10
# Margins are stretched before the loss, so that a typical text lies on the curved part of it.
SHARPNESS = 4.0
_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_CHUNK = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased letters in UTF-8, words apart by one space; long texts in pieces that overlap."""
    octets = np.frombuffer(f" {_NOT_LETTERS.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass"), np.uint8)
    longest = max(ORDERS)
    for at in range(0, len(octets), _CHUNK):
        piece = octets[at : at + _CHUNK + longest - 1].astype(np.uint32)
        for order in ORDERS:
            starts = min(_CHUNK, len(piece) - order + 1)
            if starts <= 0:
                continue
            code = np.full(starts, order, np.uint32)
            for k in range(order):
                code = code * np.uint32(0x01000193) ^ piece[k : k + starts]
            code *= np.uint32(0x9E3779B1)
            yield (code >> np.uint32(16)).astype(np.intp)


def codewords(languages: int) -> np.ndarray:
    """A row of signs per language. No two rows are alike and no column is constant, or repeats another turned round."""
    if languages <= 1:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        splits = np.arange(1 << (languages - 1))[1:]
        signs = np.stack([np.where(splits >> i & 1, 1, -1) for i in range(languages - 1)])
        return np.vstack([-np.ones((1, len(splits)), np.int64), signs]).astype(np.int8)
    rng = np.random.default_rng(languages)
    bits = int(np.ceil(RANDOM_BITS * np.log2(languages)))
    best, apart = None, -1
    for _ in range(64):
        order = np.argsort(rng.random((bits, languages)), axis=1)
        code = np.where(order < languages // 2, 1, -1).T.astype(np.int8)
        distance = (bits - code.astype(int) @ code.T) // 2 + bits * np.eye(languages, dtype=int)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray

    def losses(self, text: str) -> np.ndarray:
        """The loss of each language; ``text`` must have a letter."""
        total, grams = np.zeros(self.weights.shape[1]), 0
        for buckets in ngram_buckets(text):
            for at in range(0, len(buckets), 1 << 16):
                part = buckets[at : at + (1 << 16)]
                total += self.weights[part].sum(axis=0, dtype=np.float64)
            grams += len(buckets)
        margins = SHARPNESS * total / max(grams, 1)
        return np.logaddexp(0, -margins * self.code).sum(axis=1)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): the score is the share of exp(-loss), the margin the loss that the runner-up has more."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, 0.0
        losses = self.losses(text)
        best = int(losses.argmin())
        odds = np.exp(losses[best] - losses)
        rest = np.delete(losses, best)
        return self.languages[best], float(1 / odds.sum()), float(rest.min() - losses[best]) if len(rest) else 1.0


def _count(text: str, lang: str):
    def totals(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, into in counts.items():
            some = np.flatnonzero(into)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * len(some)), "bucket": pa.array(some.astype(np.int32)), "n": pa.array(into[some])}
            )
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in small(batches):
            for t, name in zip(batch.column(text).to_pylist(), batch.column(lang).to_pylist()):
                if name is None or not has_letter(t):
                    continue
                if name not in counts and len(counts) >= HELD_LANGUAGES:
                    yield from totals(counts)
                into = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                for buckets in ngram_buckets(t):
                    into += np.bincount(buckets, minlength=BUCKETS)
        yield from totals(counts)

    return run


def _log_odds(languages: tuple[str, ...], sums: np.ndarray, code: np.ndarray):
    """For applyInArrow: the log-odds of each bit for the buckets of a group, which are those with one remainder by ``_GROUPS``."""

    def run(group: pa.Table) -> pa.Table:
        buckets = group.column("bucket").to_numpy()
        first = int(buckets[0]) % _GROUPS
        counts = np.zeros((BUCKETS // _GROUPS, len(languages)))
        counts[buckets // _GROUPS, np.searchsorted(languages, group.column("lang").to_pylist())] = group.column("n").to_numpy()
        # Languages weigh alike within a side, whatever the number of their texts.
        shares = (counts + 0.5) / (sums + 0.5 * BUCKETS)
        ones = (code > 0).astype(float)
        means = shares @ (ones / ones.sum(axis=0)), shares @ ((1 - ones) / (1 - ones).sum(axis=0))
        odds = (np.log(means[0]) - np.log(means[1])).astype(np.float32)
        return pa.table(
            {"bucket": pa.array(np.arange(first, BUCKETS, _GROUPS, dtype=np.int32)), "odds": pa.array(list(odds), pa.list_(pa.float32()))}
        )

    return run


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model from all rows of ``train`` with a language and a letter; one pass over the texts."""
    found = train.select(text, lang).mapInArrow(_count(text, lang), "lang string, bucket int, n long")
    counts = stored(found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = tuple(sorted(totals))
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    if len(languages) > 1:
        sums = np.array([totals[name] for name in languages], float)
        # Buckets that no text has weigh by the totals alone.
        empty = pa.table({"bucket": pa.array([0], pa.int32()), "lang": pa.array(languages[:1]), "n": pa.array([0], pa.int64())})
        weights[:] = _log_odds(languages, sums, code)(empty).column("odds")[0].as_py()
        by_group = counts.groupBy(F.col("bucket") % _GROUPS)
        found = by_group.applyInArrow(_log_odds(languages, sums, code), "bucket int, odds array<float>").toArrow()
        odds = found.column("odds").combine_chunks().flatten().to_numpy()
        weights[found.column("bucket").to_numpy()] = odds.reshape(-1, code.shape[1])
    return LanguageModel(languages, code, weights)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``margin``, the distance to the second nearest codeword."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch, _: int) -> dict[str, pa.Array]:
        got = [shared.value.predict(t) for t in batch.column(text).to_pylist()]
        names, scores, margins = zip(*got) if got else ((), (), ())
        return {
            "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(scores, pa.float64()),
            "margin": pa.array(margins, pa.float64()),
        }

    kept = docs.drop("lang_pred", "score", "margin")
    return kept.mapInArrow(add_columns(make), schema_with(kept, lang_pred="string", score="double", margin="double"))


def held_out(ids: str = "doc_id") -> Column:
    """One row in three, by its id. A null id is held out: it can't be told whether it is training data."""
    return F.coalesce(F.pmod(F.crc32(F.col(ids).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def is_ambiguous(least_margin: float = 0.02) -> Column:
    """Whether a row of :func:`identify` is ``und``, or its two nearest codewords are about equally far."""
    return (F.col("lang_pred") == UNDETERMINED) | (F.col("margin") < least_margin)
