"""Benchmark windows in documents against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from wardrisk.llm import decontamination

from .conftest import prose

BENCHMARK = "item_id long, text string, doc_id long, gram string"


def plain_words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, width=10):
    windows = {}
    for i, text in items:
        words = plain_words(text)
        n = min(width, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[at:at + n]), set()).add(i)
    out = []
    for d, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                owners = windows.get(tuple(words[at:at + n]))
                if owners:
                    hit |= set(range(at, at + n))
                    found |= owners
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((d, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture(scope="module")
def items(corpus):
    """Items from the documents' own words, short ones, repeated ids, nulls and odd texts."""
    rng = random.Random(8)
    texts = dict(corpus)
    out = []
    for i in range(12):
        words = texts[i].split()
        out.append((i, " ".join(words[rng.randrange(5):][:rng.randint(3, 25)]).upper() + "!"))
    return out + [(20, "the"), (21, None), (22, " ... "), (23, "Straße CAFÉ"), (24, "café"), (0, "a b c"), (None, "a b"),
                  (None, None), (25, prose(rng, 30)), (26, "line one line one line two line one")]


def key(row):
    return str(row)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_against_brute_force(spark, docs, corpus, items, broadcast_bytes):
    """With a broadcast window set and with a shuffled one; documents and items have columns of clashing names."""
    table = spark.createDataFrame([(i, t, None, None) for i, t in items], BENCHMARK)
    got = decontamination.contamination(docs, table, broadcast_bytes=broadcast_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain(corpus, items), key=key)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_other_widths_and_repeats(spark, items):
    rows = [(1, "one two three four five"), (1, "one two three four five"), (None, "Three FOUR"), (2, None), (3, "")]
    bench = [(7, "two three four"), (7, "four five"), (8, "three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(bench, "item_id long, text string")
    for width in (1, 2, 3):
        got = decontamination.contamination(docs, table, width=width).collect()
        assert sorted((tuple(r) for r in got), key=key) == sorted(plain(rows, bench, width), key=key)


def test_long_text_and_many_hits(spark):
    """A text of some MB, every word of which is hit, by windows that overlap."""
    rng = random.Random(1)
    words = [rng.choice("ab") for _ in range(1_200_000)]
    text = " ".join(words)
    bench = [(i, " ".join(w)) for i, w in enumerate(["ab", "ba", "aa", "bb"])]
    got = decontamination.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                                        spark.createDataFrame(bench, "item_id long, text string")).first()
    assert tuple(got)[:4] == (1, 1_200_000, 1_200_000, 4)


def test_empty_tables(spark, docs, corpus, items, empty):
    table = spark.createDataFrame([(i, t, None, None) for i, t in items], BENCHMARK)
    assert decontamination.contamination(empty, table).collect() == []
    none = decontamination.contamination(docs, table.where("false")).collect()
    assert len(none) == len(corpus) and not any(r["contaminated"] for r in none)
    assert {r["items_sha256"] for r in none} == {hashlib.sha256(b"").hexdigest()}


def test_equal_hashes_are_verified(spark, monkeypatch):
    """With one hash for all words every place is a candidate; still only equal words are hits."""
    monkeypatch.setattr(decontamination.F, "xxhash64", lambda *c: F.lit(1).cast("long") + F.lit(0) * F.hash(*c))
    rows, bench = [(1, "a b c d"), (2, "c d e"), (3, "x y")], [(1, "c d"), (2, "y z")]
    got = decontamination.contamination(spark.createDataFrame(rows, "doc_id long, text string"),
                                        spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, bench)


def test_removal(spark):
    rows = [(1, "Keep this. The QUICK, brown fox jumps! And this.", "x"), (2, "nothing here", "y"), (3, None, None),
            (4, "quick brown fox", "z"), (5, "the quick brown fox; quick brown fox jumps", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_ string")
    bench = spark.createDataFrame([(1, "quick brown fox"), (2, "fox jumps")], "item_id long, text string")
    spans = decontamination.without_contamination(docs, bench)
    assert spans.columns == docs.columns
    assert sorted(tuple(r) for r in spans.collect()) == [
        (1, "Keep this. The ! And this.", "x"), (2, "nothing here", "y"), (3, None, None), (4, "", "z"), (5, "the ", "v")]
    kept = decontamination.without_contamination(docs, bench, most_share=0.5).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 3]
    whole = decontamination.without_contamination(docs, bench, remove="documents").collect()
    assert sorted(r["doc_id"] for r in whole) == [2, 3]
    with pytest.raises(ValueError):
        decontamination.without_contamination(docs, bench, remove="words")


def test_no_python_worker(spark, docs, items):
    """The main path is DataFrame functions alone."""
    table = spark.createDataFrame([(i, t, None, None) for i, t in items], BENCHMARK)
    found = decontamination.Contamination(docs, table)
    for frame in (found.rows, found.hits, found.digests()):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
