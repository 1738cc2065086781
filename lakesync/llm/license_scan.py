"""License scan: templates with markup, compiled into word automata that accept a text where all mandatory wording stands word for word.

A template is wording with two kinds of markup. ``<<beginOptional>> ... <<endOptional>>`` may be there or not, and nests. ``<<var;name=x;words=a-b>>``
stands for any ``a`` to ``b`` words, such as a holder's name. All else is mandatory. Texts and templates are read alike:
A-Z lower-cased, words are runs of digits, letters and characters beyond ASCII, so layout and punctuation play no part.

All templates become one nondeterministic automaton over words, which is made deterministic as far as texts call for it. It is started at
every word with which a template can begin, and for each template the longest stretch from there is its place.

Null texts have no words. Texts of any length are read whole, in memory linear in the text. Null ids and repeated rows stay as they are. An empty
table gives an empty table. Input columns with the name of an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import add_columns, schema_with

# Every byte of a word as it is read; all others part words.
_READ = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MARKUP = re.compile(r"<<(.*?)>>", re.DOTALL)
_VAR = re.compile(r"var;name=\w+;words=(\d+)-(\d+)")
_MATCHES = "array<struct<template:string,label:string,start:bigint,words:bigint>>"
_MATCH_TYPE = pa.list_(
    pa.struct([("template", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("words", pa.int64())])
)


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    wording: str


# The plain phrases every scan knows: fixed values.
BASE = (
    Template("base-gpl", "gpl", "gnu general public license"),
    Template("base-apache", "apache", "apache license"),
    Template("base-cc-by", "cc-by", "cc by"),
    Template("base-mit", "mit", "mit license"),
)

# Wording of public licenses and of the notices that name them: fixed values.
_LINE = "<<beginOptional>>this <<var;name=work;words=1-3>> is<<endOptional>> "
_UNDER = "under <<beginOptional>>the <<beginOptional>>terms of the<<endOptional>><<endOptional>> "
_HOLDER = "Copyright <<beginOptional>>(c)<<endOptional>> <<var;name=holder;words=1-12>> <<beginOptional>>All rights reserved.<<endOptional>>"
_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_GNU = """it under the terms of the <<beginOptional>>{kind}<<endOptional>> General Public License as published by the Free Software Foundation<<beginOptional>>; either<<endOptional>>
version {version} of the License<<beginOptional>>, or (at your option) any later version<<endOptional>>."""

TEMPLATES = (
    Template("notice-mit", "mit", _LINE + "released " + _UNDER + "MIT License"),
    Template("notice-mit-licensed", "mit", _LINE + "licensed " + _UNDER + "MIT License"),
    Template("notice-apache-2.0", "apache-2.0", _LINE + "licensed " + _UNDER + "Apache License, <<beginOptional>>Version<<endOptional>> 2.0"),
    Template("notice-gpl-2.0", "gpl-2.0", _LINE + "licensed " + _UNDER + "GNU General Public License, <<beginOptional>>version<<endOptional>> 2"),
    Template("notice-gpl-3.0", "gpl-3.0", _LINE + "licensed " + _UNDER + "GNU General Public License, <<beginOptional>>version<<endOptional>> 3"),
    Template("notice-cc-by-4.0", "cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0"),
    Template("notice-cc-by-sa-4.0", "cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA 4.0"),
    Template("notice-cc-by-nc-4.0", "cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0"),
    Template("notice-cc-by-nc-sa-4.0", "cc-by-nc-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC-SA 4.0"),
    Template(
        "notice-cc-named",
        "cc-by-4.0",
        """licensed under <<beginOptional>>a<<endOptional>> Creative Commons Attribution 4.0 <<beginOptional>>International<<endOptional>> License""",
    ),
    Template(
        "header-apache-2.0",
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this <<var;name=work;words=1-3>> except in compliance with the License.
        You may obtain a copy of the License at <<beginOptional>><<var;name=address;words=1-8>><<endOptional>> Unless required by applicable law or agreed to in
        writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    Template("header-gpl-2.0", "gpl-2.0", "redistribute it and/or modify " + _GNU.format(kind="GNU", version=2)),
    Template("header-gpl-3.0", "gpl-3.0", "redistribute it and/or modify " + _GNU.format(kind="GNU", version=3)),
    Template(
        "header-mpl-2.0",
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    Template(
        "text-mit",
        "mit",
        """<<beginOptional>>The MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>> <<beginOptional>>"""
        + _HOLDER
        + """<<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to
        deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
        sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=liable;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES
        OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ),
    Template(
        "text-isc",
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
        copyright notice and this permission notice appear in all copies.""",
    ),
    Template("text-bsd-2-clause", "bsd-2-clause", _REDISTRIBUTION + "THIS SOFTWARE IS PROVIDED BY"),
    Template(
        "text-bsd-3-clause",
        "bsd-3-clause",
        _REDISTRIBUTION
        + """<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=organization;words=1-12>> nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    ),
    Template(
        "text-zlib",
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from
        the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
        redistribute it freely, subject to the following restrictions:""",
    ),
    Template(
        "text-unlicense",
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
)


def read_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_READ).split()


def parsed(wording: str) -> list:
    """The parts of a template in order: a word, a list of parts that are optional, or (least, most) words of any kind."""
    out: list = []
    open_: list[list] = [out]
    at = 0
    for mark in [*_MARKUP.finditer(wording), None]:
        open_[-1].extend(read_words(wording[at : mark.start() if mark else None].encode()))
        if mark is None:
            break
        at = mark.end()
        said = mark.group(1)
        if said == "beginOptional":
            open_[-1].append([])
            open_.append(open_[-1][-1])
        elif said == "endOptional" and len(open_) > 1:
            open_.pop()
        elif of := _VAR.fullmatch(said):
            open_[-1].append((int(of.group(1)), int(of.group(2))))
        else:
            raise ValueError(f"unknown or unpaired markup: {said}")
    if len(open_) > 1:
        raise ValueError("an optional part does not end")
    return out


class Automaton:
    """All templates as one automaton: sets of its states are made states of a deterministic one when a text reaches them."""

    def __init__(self, templates: Sequence[Template]):
        # Of each state the next ones by word, by any word, and without a word.
        self.by_word: list[dict[bytes, int]] = []
        self.by_any: list[int | None] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        begin = self._state()
        for number, template in enumerate(templates):
            first = self._state()
            self.free[begin].append(first)
            last = self._compile(parsed(template.wording), first)
            if last in self._closed([first]):
                raise ValueError(f"template {template.name} has no mandatory words")
            self.accepts[last] = number
        self.start = frozenset(self._closed([begin]))
        #: The words at which a template can begin; None if any word will do.
        self.first_words = None if any(self.by_any[s] is not None for s in self.start) else {w for s in self.start for w in self.by_word[s]}
        self._numbers: dict[frozenset[int], int] = {}
        self._sets: list[frozenset[int]] = []
        self._next: list[dict[bytes | None, int]] = []
        self._found: list[tuple[int, ...]] = []
        self._words = {w for known in self.by_word for w in known}
        self._number(self.start)

    def _state(self) -> int:
        self.by_word.append({})
        self.by_any.append(None)
        self.free.append([])
        return len(self.free) - 1

    def _compile(self, parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, list):
                end = self._compile(part, at)
                after = self._state()
                self.free[end].append(after)
                self.free[at].append(after)
                at = after
            elif isinstance(part, tuple):
                least, most = part
                passed = []
                for count in range(most):
                    if count >= least:
                        passed.append(at)
                    following = self._state()
                    self.by_any[at] = following
                    at = following
                after = self._state()
                for state in (*passed, at):
                    self.free[state].append(after)
                at = after
            else:
                # A state of its own for each word, so that no two branches share one.
                here, following = self._state(), self._state()
                self.free[at].append(here)
                self.by_word[here][part] = following
                at = following
        return at

    def _closed(self, states: Sequence[int]) -> list[int]:
        seen, waiting = list(states), list(states)
        while waiting:
            for following in self.free[waiting.pop()]:
                if following not in seen:
                    seen.append(following)
                    waiting.append(following)
        return seen

    def _number(self, states: frozenset[int]) -> int:
        if states not in self._numbers:
            self._numbers[states] = len(self._sets)
            self._sets.append(states)
            self._next.append({})
            self._found.append(tuple(sorted(self.accepts[s] for s in states if s in self.accepts)))
        return self._numbers[states]

    def _step(self, number: int, word: bytes | None) -> int:
        """The state after a word; None stands for every word that is in no template."""
        following = set()
        for s in self._sets[number]:
            if (known := self.by_word[s].get(word)) is not None:
                following.add(known)
            if self.by_any[s] is not None:
                following.add(self.by_any[s])
        # -1: no template can go on.
        found = self._number(frozenset(self._closed(list(following)))) if following else -1
        self._next[number][word] = found
        return found

    def places(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template's number, first word, number of words) of every place, the longest for each template and first word."""
        firsts, known = self.first_words, self._words
        out = []
        starts = range(len(words)) if firsts is None else [i for i, w in enumerate(words) if w in firsts]
        for start in starts:
            state, longest = 0, {}
            for at in range(start, len(words)):
                word = words[at] if words[at] in known else None
                following = self._next[state].get(word)
                state = self._step(state, word) if following is None else following
                if state < 0:
                    break
                for number in self._found[state]:
                    longest[number] = at + 1 - start
            out += [(number, start, n) for number, n in sorted(longest.items())]
        return out


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + TEMPLATES, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``places`` (template, label, start, words: by start) and ``covered``, the number of words in a place.

    With ``keep_text=False`` the text itself is not handed back.
    """
    templates = tuple(templates)
    made: list[Automaton] = []

    def make(batch: pa.RecordBatch, before: int) -> dict[str, pa.Array]:
        if not made:
            made.append(Automaton(templates))
        counts, places, covered = [], [], []
        for value in batch.column("covered"):
            words = read_words(value.as_py())
            found = made[0].places(words)
            inside, end = 0, 0
            for _, start, n in found:
                inside += max(0, start + n - max(start, end))
                end = max(end, start + n)
            counts.append(len(words))
            covered.append(inside)
            places.append(
                [{"template": templates[k].name, "label": templates[k].label, "start": s, "words": n} for k, s, n in found]
            )
        return {
            "n_words": pa.array(counts, pa.int64()),
            "places": pa.array(places, _MATCH_TYPE),
            "covered": pa.array(covered, pa.int64()),
        }

    kept = docs.drop(*{"n_words", "places", "covered"} - {text})
    others = [c for c in kept.columns if c != text or (keep_text and text not in ("n_words", "places", "covered"))]
    ready = kept.select(*others, F.col(text).cast("binary").alias("covered"))
    return ready.mapInArrow(add_columns(make), schema_with(ready, n_words="long", places=_MATCHES, covered="long"))


def labels(places: str | Column = "places") -> Column:
    """The distinct labels of some places, sorted, joined by commas; the empty string without any."""
    column = F.col(places) if isinstance(places, str) else places
    return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda p: p["label"]))), ",")


def of_base(places: str = "places") -> Column:
    """The places of the plain phrases."""
    return F.filter(places, lambda p: p["template"].isin(*[t.name for t in BASE]))


def _pattern(parts: list) -> str:
    """A template's parts as a pattern over words that each have a space behind them."""
    out = ""
    for part in parts:
        if isinstance(part, list):
            out += f"({_pattern(part)})?"
        elif isinstance(part, tuple):
            out += f"([^ ]+ ){{{part[0]},{part[1]}}}"
        else:
            out += part.decode() + " "
    return out


def _longest(parts: list) -> int:
    return sum(_longest(p) if isinstance(p, list) else p[1] if isinstance(p, tuple) else 1 for p in parts)


def scan_sql(templates: Sequence[Template] = BASE + TEMPLATES) -> str:
    """DuckDB SQL for the query's rows: places found by patterns that are anchored at every word that can begin one."""
    firsts = Automaton(templates).first_words
    begins = "true" if firsts is None else "words[i + 1] IN (" + ", ".join(f"'{w.decode()}'" for w in sorted(firsts)) + ")"
    reach = max(_longest(parsed(t.wording)) for t in templates)
    base = ", ".join(f"'{t.name}'" for t in BASE)
    known = ", ".join(f"('{t.name}', '{t.label}', '^({_pattern(parsed(t.wording))})')" for t in templates)
    return f"""
    WITH read AS (
        SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
        FROM documents
    ), known(template, label, pattern) AS (VALUES {known}),
    starts AS (
        SELECT row_id, i AS start, array_to_string(words[i + 1 : i + {reach}], ' ') || ' ' AS rest
        FROM (SELECT row_id, words, unnest(range(len(words))) AS i FROM read) WHERE {begins}
    ), places AS (
        SELECT row_id, start, template, label, len(string_split(regexp_extract(rest, pattern), ' ')) - 1 AS n
        FROM starts, known WHERE regexp_matches(rest, pattern)
    ), covered AS (
        SELECT row_id, count(DISTINCT w) AS n FROM (SELECT row_id, unnest(range(start, start + n)) AS w FROM places) GROUP BY row_id
    ), found AS (
        SELECT row_id, count(*) FILTER (template IN ({base})) AS n_base,
            min(start) FILTER (template IN ({base})) AS first_word, max(start) FILTER (template IN ({base})) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (template IN ({base})) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM places GROUP BY row_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
        last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        CASE WHEN len(words) = 0 THEN 0.0::DOUBLE ELSE coalesce(covered.n, 0)::DOUBLE / len(words) END AS score
    FROM read LEFT JOIN found USING (row_id) LEFT JOIN covered USING (row_id)
    """
