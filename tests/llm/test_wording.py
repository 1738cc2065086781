"""Spelling variants, periodic runs and license templates against brute force, and their results for odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakesync.llm import license_scan, periodic_runs, spelling_variants
from lakesync.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, repeated and very long rows, and names that operators use for their own columns."""
    rows = [
        (1, "Colour colours COLOURS colours. mit license", 1, "a", 1),
        (1, "Colour colours COLOURS colours. mit license", 1, "a", 1),
        (2, None, None, None, None),
        (None, "", 2, "b", 2),
        (None, None, None, None, None),
        (3, "1234 !! \t\n", 3, "c", 3),
        (4, "wort " * 60_000, 4, "d", 4),
        (5, "colorr colouur färbt färbt färbtt färbt", 5, "e", 5),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words long, runs string, covered long")


# -- spelling variants -------------------------------------------------------------------------------------------


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    out = {}
    for word, n in counts.items():
        near = [v for v in counts if v != word and abs(len(v) - len(word)) < 2 and are_near(word, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 2 * n else None
        out[word] = (n, len(near), form, counts[form] if form else None)
    for word, (*row, form, form_n) in out.items():
        root = word
        while out[root][2]:
            root = out[root][2]
        out[word] = (*row, form, form_n, root)
    return out


def got_variants(words, **how):
    return {r.word: tuple(r)[1:] for r in spelling_variants.variants(words, **how).collect()}


@pytest.mark.parametrize("most", [spelling_variants.MOST, 7])
def test_variants_against_all_pairs(spark, most):
    rng = random.Random(1)
    counts = {}
    for letters, size in (("ab", 120), ("abcdé", 150), ("xyzÿ×", 150)):
        for _ in range(size):
            word = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 10)))
            counts[word] = rng.choice([3, 3, 4, 6, 9, 20, 50, 120, 300])
    counts |= {"prefix" + "".join(rng.choice("ab") for _ in range(6)): rng.randrange(3, 99) for _ in range(60)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got_variants(frame, most=most) == plain_variants(counts)


def test_variants_follow_long_chains(spark):
    counts = {"a" * (5 + i): 3 * 2**i for i in range(20)}
    got = got_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert got == plain_variants(counts) and {r[-1] for r in got.values()} == {"a" * 24}


def test_vocabulary_is_that_of_the_contract(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    counts = Counter()
    for doc_id, text in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    wanted = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    found = spelling_variants.vocabulary(docs, change=spelling_variants.misspelt)
    assert dict(found.collect()) == wanted and len(wanted) > 500


def test_vocabulary_of_odd_rows(spark, odd):
    found = spelling_variants.vocabulary(odd)
    assert dict(found.collect()) == {"colours": 6, "färbt": 3}
    assert got_variants(found) == {"colours": (6, 0, None, None, "colours"), "färbt": (3, 0, None, None, "färbt")}
    assert spelling_variants.vocabulary(odd.limit(0)).count() == 0
    assert got_variants(found.limit(0)) == {}
    with pytest.raises(ValueError):
        spelling_variants.variants(found, ratio=1)


# -- periodic runs -----------------------------------------------------------------------------------------------


def plain_runs(words, shortest=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1 if j == i else j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        words = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            if len(words) > 3:
                a = rng.randrange(len(words))
                p = rng.randrange(1, (len(words) - a) // 3 + 2)
                for i in range(a, rng.randrange(a, len(words) + 1)):
                    words[i] = words[a + (i - a) % p]
        shortest = rng.choice([1, 3, 6, 24])
        assert periodic_runs.word_runs([b"%d" % w for w in words], shortest) == plain_runs(words, shortest)
        if words:  # without the cut into stretches
            assert periodic_runs.runs_of([w + 1 for w in words], shortest) == plain_runs(words, shortest)


def test_common_extensions():
    rng = random.Random(3)
    symbols = [rng.randrange(1, 3) for _ in range(700)]
    same = periodic_runs.CommonExtensions(*periodic_runs.SuffixTree(symbols).tour())
    pairs = [rng.sample(range(701), 2) for _ in range(3000)]
    for (a, b), n in zip(pairs, same(*__import__("numpy").array(pairs).T).tolist()):
        assert symbols[a : a + n] == symbols[b : b + n] and (symbols + [0])[a + n : a + n + 1] != (symbols + [0])[b + n : b + n + 1]


def plain_row(doc_id, text, loop=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if loop and h is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    hashes = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
    return (doc_id, len(runs), *best, milli, *hashes)


def test_runs_query_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = [rng.choice("ab cé 日 dd".split()) for _ in range(rng.randrange(90))]
        at = rng.randrange(len(words) + 1)
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t", " \x0b", " "] * 20 + ["\u00a0"]) for w in words[:at] + words[:3] * 9 + words[at:])))
    rows += [(300, None), (301, ""), (None, "a " * 30), (302, "x y " * 3000), (302, "x y " * 3000), (310, "one"), (320, " \n ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(str(plain_row(*r)) for r in rows)
    assert sum(r[1] > 0 for r in got) > 100


def test_runs_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: tuple(r) for r in docs if len((r.text or "").split()) < 1500}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()}
    assert len(got) == len(docs) and all(got[i] == plain_row(*r) for i, r in short.items())


def test_runs_of_odd_rows(spark, odd):
    found = periodic_runs.find_runs(odd)
    assert set(found.columns) == {"doc_id", "text", "covered", "n_words", "runs", "collapsed"}
    by_id = {(r.doc_id, r.text is None): r for r in found.collect()}
    assert found.count() == odd.count()
    assert by_id[2, True].runs == [] and by_id[2, True].collapsed == "" and by_id[2, True].n_words == 0
    assert [tuple(r) for r in by_id[4, False].runs] == [(0, 60_000, 1)] and by_id[4, False].collapsed == "wort"
    assert periodic_runs.find_runs(odd.limit(0)).count() == 0
    by_runs = periodic_runs.find_runs(odd.select("doc_id", F.col("text").alias("runs")), text="runs")
    assert set(by_runs.columns) == {"doc_id", "n_words", "runs", "collapsed"}
    assert periodic_runs.looped(odd).columns == odd.columns


# -- license templates -------------------------------------------------------------------------------------------


def plain_places(template, words):
    """(start, length) of the longest place at every start, by trying all ways through the template."""

    def ends(parts, at):
        if not parts:
            return {at}
        part, rest = parts[0], parts[1:]
        if isinstance(part, list):
            reached = {at} | ends(part, at)
        elif isinstance(part, tuple):
            reached = {at + k for k in range(part[0], part[1] + 1) if at + k <= len(words)}
        else:
            reached = {at + 1} if at < len(words) and words[at] == part else set()
        return set().union(*[ends(rest, e) for e in reached]) if reached else set()

    parts = license_scan.parsed(template.wording)
    found = ((i, max(ends(parts, i), default=i) - i) for i in range(len(words)))
    return [(s, n) for s, n in found if n]


TEST_TEMPLATES = (
    license_scan.Template("t0", "l0", "a b"),
    license_scan.Template("t1", "l1", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> a"),
    license_scan.Template("t2", "l2", "<<beginOptional>>c<<endOptional>> b <<var;name=x;words=0-3>> c"),
    license_scan.Template("t3", "l1", "a <<var;name=x;words=2-4>> <<beginOptional>>a b<<endOptional>>"),
    license_scan.Template("t4", "l4", "<<var;name=x;words=1-2>> d <<var;name=y;words=0-1>> d"),
)


def test_automaton_against_all_ways():
    rng = random.Random(5)
    for templates in (TEST_TEMPLATES, TEST_TEMPLATES[:4]):
        automaton = license_scan.Automaton(templates)
        for _ in range(300):
            words = [rng.choice([b"a", b"b", b"c", b"d", b"other"]) for _ in range(rng.randrange(25))]
            got = sorted(automaton.places(words))
            wanted = sorted((k, s, n) for k, t in enumerate(templates) for s, n in plain_places(t, words))
            assert got == wanted


def test_template_markup():
    with pytest.raises(ValueError):
        license_scan.parsed("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        license_scan.parsed("a <<endOptional>>")
    with pytest.raises(ValueError):
        license_scan.parsed("a <<what>>")
    with pytest.raises(ValueError):
        license_scan.Automaton([license_scan.Template("t", "l", "<<beginOptional>>a<<endOptional>>")])


MIT = next(t for t in license_scan.TEMPLATES if t.name == "text-mit").wording


def found_labels(spark, *texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in license_scan.scan(docs).select(license_scan.labels()).collect()]


def test_whole_license_texts(spark):
    granted = MIT[MIT.index("Permission") :].replace("<<var;name=liable;words=1-12>>", "THE AUTHORS OR COPYRIGHT HOLDERS")
    plain = re.sub(r"<<.*?>>", "", granted)
    without = plain.replace("(including the next paragraph)", "")
    changed = plain.replace("without restriction", "with restriction")
    held = "Copyright (c) 2001 Zoë and Sons\n\n" + plain.upper()
    assert found_labels(spark, plain, without, changed, held) == ["mit", "mit", "", "mit"]


def test_notices(spark):
    texts = [
        "Released under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under CC BY-NC 4.0.",
        "the gnu general  public\nlicense and the GNU-General_Public license",
        "permit license, ccby, mitlicense, gnü general public license",
    ]
    assert found_labels(spark, *texts) == ["mit", "gpl,gpl-3.0", "apache,apache-2.0", "cc-by,cc-by-nc-4.0", "gpl", ""]


def test_scan_of_odd_rows(spark, odd):
    found = license_scan.scan(odd)
    assert set(found.columns) == {*odd.columns, "places"}
    by_id = {(r.doc_id, r.text is None): r for r in found.collect()}
    assert found.count() == odd.count()
    assert by_id[2, True].places == [] and (by_id[2, True].n_words, by_id[2, True].covered) == (0, 0)
    assert by_id[None, False].n_words == 0 and by_id[4, False].n_words == 60_000
    assert [tuple(p) for p in by_id[1, False].places] == [("base-mit", "mit", 4, 2)] and by_id[1, False].covered == 2
    assert license_scan.scan(odd.limit(0)).count() == 0


def test_base_places_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for r in QUERIES["op13_license_templates"](spark, SF_DIR).collect():
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in docs[r.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        at = [(i, n) for p, n in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        wanted = (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({n for _, n in at})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == wanted
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
