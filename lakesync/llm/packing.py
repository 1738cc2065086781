"""Packing by concatenating and cutting: token ids of all documents in a row, cut every ``length`` ids.

The first pass encodes each text once, ends it with ``end_id``, and writes its ids with their offset inside the task that made them.
One total per task (not per row) gives, as running sums, where each task's ids begin overall. The second pass adds the two and cuts every document at
multiples of ``length``; a document that crosses a boundary gives one record on each side. Nothing is shuffled. Every sequence
but the last is full; the last is padded by whoever reads it.

Null and empty texts are the end id alone. Texts of any length are encoded whole; strings of special tokens become those tokens.
Repeated rows are packed as often as they occur. Without documents there are no pieces. Input columns with the name of an
output column are replaced.
"""

from __future__ import annotations

import array
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import schema_with, small, stored

# Words that each process remembers, and their greatest length.
_CACHED, _CACHED_LENGTH = 300_000, 64
# A space after white space, which may be one token with it.
_RUN_OF_SPACE = re.compile(r" (?<=\s\s)")
_encoders: dict[str, Encoder] = {}


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes: themselves where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _kind(category: str) -> str:
    return category[0] if category[0] in "LNZ" else "other"


def _unsettled() -> re.Pattern:
    """Characters whose kind (letter, number, space, other) is not the same in the first and last Unicode version that Python has.

    Libraries with tables of different versions may split texts with them differently.
    """
    first, last = unicodedata.ucd_3_2_0.category, unicodedata.category
    ranges, start = [], None
    for code in range(128, 0x20001):
        char = chr(code)
        differs = code == 0x20000 or first(char) == "Cn" or _kind(first(char)) != _kind(last(char))
        if differs and start is None:
            start = code
        elif not differs and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}\\U{start:08x}-\\U0010ffff]")


class Encoder:
    """A tokenizers file, read as it is, with a faster way to the same ids for byte-level BPE files.

    The faster way is tiktoken over the file's own vocabulary, and words that follow a single space are remembered, since no
    token crosses a space after a character that is not white space. It is taken where the file proves that ids are the same
    (:func:`same_merges`); characters that two Unicode tables may see differently, texts with special tokens, and other files go to
    the tokenizers library.
    """

    # Fixed value: the split pattern of this byte-level family.
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.specials = [t["content"] for t in model.get("added_tokens", ())]
        self.fast = self._ranked(model) if same_merges(self.slow, model) else None
        self.unsettled = _unsettled()
        self.known: dict[str, bytes] = {}

    def _ranked(self, model: dict):
        import tiktoken

        back = _byte_of_char()
        words = model["model"]["vocab"].items()
        ranks = {bytes(back[c] for c in word): i for word, i in words if word not in self.specials}
        return tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _exact(self, text: str) -> bytes:
        return array.array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()

    def _quick(self, text: str) -> bytes:
        if self.unsettled.search(text):
            return self._exact(text)
        return array.array("I", self.fast.encode_ordinary(text)).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.fast is None or any(s in text for s in self.specials):
            return self._exact(text)
        if _RUN_OF_SPACE.search(text):
            return self._quick(text)
        first, *words = text.split(" ")
        known = self.known
        try:
            ids = [known[w] for w in words]
        except KeyError:
            if len(known) > _CACHED:
                known.clear()
            ids = [known.get(w) or self._word(w) for w in words]
        return self._quick(first) + b"".join(ids)

    def _word(self, word: str) -> bytes:
        ids = self._quick(" " + word)
        if len(word) <= _CACHED_LENGTH:
            self.known[word] = ids
        return ids


def same_merges(tokenizer, model: dict) -> bool:
    """Whether merging any two neighbours into the token of least id, as tiktoken does, gives the ids that the file's merges give.

    It does if the file is byte-level BPE with its own split pattern and nothing besides, every byte is a token, ids rise in the order of
    the merges, and the merges make of each token's bytes that one token. For then two neighbours that form a token without being one of the merges
    cannot occur: inside that token's bytes the merges would have stopped there. The whole vocabulary is looked at, once for each process.
    """
    bpe, pre, post = model["model"], model.get("pre_tokenizer") or {}, model.get("post_processor") or {}
    if bpe["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return False
    if post.get("type", "ByteLevel") not in ("ByteLevel", "TemplateProcessing") or model.get("normalizer"):
        return False
    if any(bpe.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    if model.get("truncation") or model.get("padding"):
        return False
    vocab = bpe["vocab"]
    special = {t["content"] for t in model.get("added_tokens", ())}
    chars = _byte_of_char()
    made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in bpe["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])) or not all(c in vocab for c in chars):
        return False
    for word, i in vocab.items():
        if word in special:
            continue
        if not all(c in chars for c in word) or [t.id for t in tokenizer.model.tokenize(word)] != [i]:
            return False
    return True


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode(path: str, text: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, at = _encoder(path), TaskContext.get().partitionId(), 0
        for batch in small(batches, 256):
            ids = [encoder.encode(t or "") + end for t in batch.column(text).to_pylist()]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            new = {
                "ids": pa.array(ids, pa.binary()),
                "doc_tokens": pa.array(counts),
                "task": pa.array(np.full(len(ids), task, np.int64)),
                "task_start": pa.array(starts),
            }
            kept = {n: batch.column(n) for n in batch.schema.names if n != text and n not in new}
            yield pa.RecordBatch.from_pydict(kept | new)

    return run


def _cut(bases: dict[int, int], length: int, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Long documents: few rows at a time, for the pieces are a second copy of their ids.
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows, starts, sizes, places, ids = [], [], [], [], []
                columns = (batch.column(n).to_pylist() for n in ("task", "task_start", "doc_tokens", "ids"))
                for row, (task, start, tokens, data) in enumerate(zip(*columns)):
                    place, done = bases[task] + start, 0
                    while done < tokens:
                        size = min(tokens - done, length - (place + done) % length)
                        rows.append(row)
                        starts.append(done)
                        sizes.append(size)
                        places.append(place + done)
                        ids.append(data[4 * done : 4 * (done + size)])
                        done += size
                kept = batch.select([*keep, "doc_tokens"]).take(pa.array(rows, pa.int64()))
                where = np.array(places, np.int64)
                yield pa.RecordBatch.from_pydict(
                    {n: kept.column(n) for n in kept.schema.names}
                    | {
                        "start": pa.array(starts, pa.int64()),
                        "length": pa.array(sizes, pa.int64()),
                        "sequence_id": pa.array(where // length),
                        "offset": pa.array(where % length),
                        "ids": pa.array(ids, pa.binary()),
                    }
                )

    return run


_MADE = {"doc_tokens", "start", "length", "sequence_id", "offset", "ids", "task", "task_start"}


def pack(docs: DataFrame, tokenizer: str, text: str = "text", length: int = 1024, end_id: int = 0) -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, ``doc_tokens``, ``start``, ``length``, ``sequence_id``, ``offset``,
    and ``ids``, the piece's ids as little-endian unsigned 32-bit numbers."""
    spark = docs.sparkSession
    kept = docs.drop(*(_MADE - {text}))
    encoded = schema_with(kept.drop(text), ids="binary", doc_tokens="long", task="long", task_start="long")
    tokens = stored(kept.mapInArrow(_encode(tokenizer, text, end_id), encoded), "tokens")
    sums = tokens.groupBy("task").agg(F.sum("doc_tokens").alias("n")).collect()
    bases, total = {}, 0
    for row in sorted(sums, key=lambda r: r["task"]):
        bases[row["task"]] = total
        total += row["n"]
    keep = [c for c in kept.columns if c != text]
    out = schema_with(
        kept.select(*keep), doc_tokens="long", start="long", length="long", sequence_id="long", offset="long", ids="binary"
    )
    return tokens.mapInArrow(_cut(bases, length, keep), out)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): each sequence whole, its pieces in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
