"""Spelling variants: every word's near words, one inserted, deleted or replaced letter away, from a bit-sliced position index.

Counting takes one pass: words are counted per text and task before anything is shuffled. Then near words are searched among words that share
half their letters: of two near words of ``n`` and ``n`` or ``n + 1`` letters, the first or the last ``n // 2`` letters are
equal, since the one error lies in one half. So a word goes to four groups: by length, as the shorter and as the longer of a
pair, and by first and by last letters; the latter are read backwards, so that a group always shares its first letters.

A group is indexed by bits, one per word: for each position and letter, the set of words that have the letter there. A word is looked
up in all words of the group at once. Its letters are read in order, and four sets are carried along: the words that agree so far, and those with
one error so far, a letter replaced, one more, or one less, whose positions are shifted by one. At the end lengths are compared. The bits stand in order
of count, so the lowest bit of a result is the most frequent near word and the number of bits is the number of near words: no pairs
are written. Two words that share both halves meet in the group by first letters only.

A group above ``most`` words is cut into blocks by hash; each word is looked up in all blocks of its group, in as many tasks.

Null texts have no words. A null id counts as the text ``null``. Repeated rows count once each. Texts of any length are read whole. Input columns
other than id and text play no part. An empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm.common import small, stored

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
# Distinct words that a task holds before it hands on its counts.
_HELD = 200_000
# Words of a group that share one bit index.
MOST = 1 << 14


def misspelt(doc_id: object, run: str, every: int = 97) -> str:
    """A lower-cased run, or, where ``every`` divides the hash h of id and run, the run without its code point h mod length."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counter(ids: str, text: str, letters: int, change: Callable[[object, str], str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        for batch in small(batches, 256):
            for key, value in zip(batch.column(ids), batch.column(text)):
                of_text: Counter[str] = Counter()
                for raw, n in Counter(_RUN.findall(value.as_py() or "")).items():
                    of_text[raw.translate(_LOWER)] += n
                name = key.as_py()
                name = "null" if name is None else name
                for word, n in of_text.items():
                    if len(word) >= letters:
                        word = change(name, word) if change else word
                        if len(word) >= letters:
                            held[word] += n
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    return run


def vocabulary(
    docs: DataFrame,
    ids: str = "doc_id",
    text: str = "text",
    letters: int = 5,
    least: int = 3,
    change: Callable[[object, str], str] | None = None,
) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur at least ``least`` times.

    Words are the longest runs of Latin letters, A-Z lower-cased. ``change(id, word)`` says what a text has instead of a word;
    it never makes one longer.
    """
    counted = docs.select(ids, text).mapInArrow(_counter(ids, text, letters, change), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _groups(word: Column) -> Column:
    """The four groups of a word: key, letters that the group shares, and the word in the group's reading direction."""
    length = F.char_length(word)
    made = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        for side, read in (("first", word), ("last", F.reverse(word))):
            shared = F.substring(read, F.lit(1), half)
            made.append(F.struct(F.concat_ws(":", F.lit(side), shorter, shared).alias("key"), shorter.alias("shorter"), read.alias("read")))
    return F.array(*made)


class PositionIndex:
    """Bit sets over some words, ``words[i]`` at bit i: by position and letter, and by length."""

    def __init__(self, words: list[str], skip: int):
        at: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for j in range(skip, len(word)):
                at.setdefault((j, word[j]), []).append(i)
        self.skip = skip
        self.all = (1 << len(words)) - 1
        self.at = {k: _bits(v) for k, v in at.items()}
        self.lengths = {k: _bits(v) for k, v in lengths.items()}

    def near(self, word: str, lengths: tuple[int, ...]) -> int:
        """The words of those lengths that are one letter away from ``word``; all share its first ``skip`` letters."""
        at, n = self.at, len(word)
        # Agreeing so far; one letter replaced; one more in the other word; one less.
        same, replaced, more, less = self.all, 0, 0, 0
        for j in range(self.skip, n):
            letter = word[j]
            here, ahead, behind = at.get((j, letter), 0), at.get((j + 1, letter), 0), at.get((j - 1, letter), 0)
            less = (less & behind) | same
            replaced = (replaced & here) | (same & ~here)
            # The letter before this one is the other word's own.
            more = (more | same) & ahead
            same &= here
        found = 0
        for length in lengths:
            sized = self.lengths.get(length, 0)
            if length == n:
                found |= replaced & sized
            elif length == n + 1:
                found |= (more | same) & sized
            elif length == n - 1:
                found |= less & sized
        return found


def _bits(places: list[int]) -> int:
    octets = bytearray(places[-1] // 8 + 1)
    for i in places:
        octets[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(octets, "little")


def look_up(side: str, shorter: int, members: list[tuple[int, str]], asked: list[str]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, count and spelling of the most frequent) for the ``asked`` words of one group.

    ``members`` are (count, word). All words read in the group's direction.
    """
    half = shorter // 2
    forward = (lambda w: w) if side == "first" else (lambda w: w[::-1])
    members = sorted(((-n, forward(w), w) for n, w in members))
    index = PositionIndex([w for _, _, w in members], half)
    both: dict[str, list[int]] = {}
    if side == "last":
        for i, (_, word, _) in enumerate(members):
            both.setdefault(word[:half], []).append(i)
    halves = {k: ~_bits(v) for k, v in both.items()}
    for word in asked:
        # Pairs of two longer words belong to another group.
        lengths = (shorter, shorter + 1) if len(word) == shorter else (shorter,)
        found = index.near(word, lengths)
        if side == "last":
            found &= halves.get(forward(word)[:half], -1)
        if found:
            n, best, _ = members[(found & -found).bit_length() - 1]
            yield forward(word), found.bit_count(), -n, best


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group and block."""
    names = ("word", "n_near", "best_n", "best")
    group, members, asked, out = None, [], [], []

    def finish() -> None:
        if group is not None and members and len(asked) + len(members) > 2:
            out.extend(look_up(group[0].split(":", 1)[0], group[2], members, asked))

    def ready() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        made = pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})
        out.clear()
        return made

    for batch in small(batches, 8192):
        columns = (batch.column(c).to_pylist() for c in ("key", "block", "shorter", "read", "n", "member"))
        for key, block, shorter, read, n, member in zip(*columns):
            if (key, block, shorter) != group:
                finish()
                group, members, asked = (key, block, shorter), [], []
            asked.append(read)
            if member:
                members.append((n, read))
        if len(out) > 50_000:
            yield ready()
    finish()
    yield ready()


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n_near, best_n, best) for every word of ``words``, a stored (word, n), that has near words.

    ``best`` is the near word of largest count, the first in code-point order if there are several.
    """
    placed = words.select("word", "n", F.explode(_groups(F.col("word"))).alias("g")).select("n", "g.*")
    sizes = placed.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > most)
    blocks = F.ceil(F.col("size") / most).cast("int")
    sized = placed.join(stored(sizes.select("key", blocks.alias("blocks")), "large-groups"), "key", "left")
    count = F.coalesce("blocks", F.lit(1))
    every = F.explode(F.sequence(F.lit(0), count - 1)).alias("block")
    dealt = sized.select("key", "shorter", "read", "n", F.pmod(F.xxhash64("read"), count).cast("int").alias("own"), every)
    dealt = dealt.withColumn("member", F.col("own") == F.col("block")).drop("own")
    sorted_ = dealt.repartition("key", "block").sortWithinPartitions("key", "block")
    found = sorted_.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("top")
    joined = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
    return joined.select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.w").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the end. Forms are ever more frequent, so there are no circles.

    Each round doubles the steps taken. A word that is no form's own word has no form, so its followers are done.
    """
    reached = stored(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")), "roots")
    while not reached.filter("NOT done").isEmpty():
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("done").alias("ends"))
        step = reached.filter("NOT done").join(onward, "root", "left")
        # Where the next word was at its root already, so is this one.
        moved = step.select("word", F.coalesce("next", "root").alias("root"), F.coalesce("ends", F.lit(True)).alias("done"))
        reached = stored(reached.filter("done").unionByName(moved), "roots")
    return reached.select("word", "root")


def variants(words: DataFrame, ratio: int = 2, most: int = MOST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n).

    A word's form is its near word of largest count (ties: the smallest), if that is at least ``ratio`` times the word's own.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    words = stored(words.select("word", "n"), "vocabulary")
    near = words.join(near_words(words, most), "word", "left")
    frequent = F.col("best_n") >= ratio * F.col("n")
    formed = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best")).alias("form"),
        F.when(frequent, F.col("best_n")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    found = formed.join(_roots(formed.filter("form IS NOT NULL").select("word", "form")), "word", "left")
    return found.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


# DuckDB has no crc32: it is worked out from bytes. Near words share what is left when one letter is taken out.
VARIANT_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
    GROUP BY doc_id, run
), coded AS (
    SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS code FROM runs WHERE length(run) >= 5
), hashed AS (
    SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(range(length(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::UBIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) AS h FROM coded, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
            ELSE run END AS word FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
    UNION SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS most, arg_min(other, (-n, other)) AS other FROM pairs GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * n THEN other END AS form,
        CASE WHEN most >= 2 * n THEN most END AS form_n
    FROM words LEFT JOIN best USING (word)
), steps AS (
    SELECT word, form AS root FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON s.root = f.word WHERE f.form IS NOT NULL
), ends AS (
    SELECT s.word, s.root FROM steps s JOIN formed f ON s.root = f.word WHERE f.form IS NULL
)
SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM formed LEFT JOIN ends USING (word)
"""
