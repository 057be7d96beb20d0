"""Collocations and their summaries against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from wardrisk.llm import collocations

from .conftest import prose


def plain(rows, longest=5, threshold=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= threshold}
    out = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(other == lang and b >= a and len(longer) > len(words)
                     and any(longer[i:i + len(words)] == words for i in range(len(longer)))
                     for (other, longer), b in candidates.items())
        if not inside:
            out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def texts(seed, n=120):
    rng = random.Random(seed)
    common = ["in the end", "of the", "New York City hall", "Ärger über alles", "a\tb"]
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(0, 40)).split()
        for _ in range(rng.randint(0, 6)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(common))
        rows.append((rng.choice([" ", "  ", "\n", ", ", "; "]).join(words), rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("a a a a a a a", "en"), ("a a a", "x"), ("x" * 70000, "en"), (" .,;:\t\x0b", "en"),
                   ("\x00 \x1c nul \x00 \x1c", "en"), ("\x00 \x1c nul", "en")] + rows[:5]


@pytest.mark.parametrize("threshold,top,chunk", [(3, 2000, 1 << 20), (2, 4, 50), (5, 2000, 300)])
def test_against_brute_force(spark, monkeypatch, threshold, top, chunk):
    """Also with chunks so small that every summary is merged many times."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "PARTITION_MASS", 500)
    rows = texts(threshold)
    schema = "text string, lang string, phrase string, part int, n string, words binary"
    docs = spark.createDataFrame([(t, x, "p", 1, None, None) for t, x in rows], schema).repartition(3)
    got = sorted(tuple(r) for r in collocations.collocations(docs, threshold=threshold, top=top).collect())
    assert got == plain(rows, threshold=threshold, top=top) and got


def test_empty_tables(spark):
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    assert collocations.collocations(docs.where("false")).collect() == []
    assert collocations.collocations(docs).collect() == []


def test_score_is_exact_beyond_64_bits(spark):
    huge = 3_000_000_007
    frame = spark.createDataFrame([("en", 2, "a b", huge), ("en", 1, "a", huge + 2), ("en", 1, "b", huge + 9)],
                                  "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9_000_000_000_019)], "lang string, n long")
    real = collocations.frequent_phrases
    collocations.frequent_phrases = lambda *a, **k: (frame, totals)
    try:
        row = collocations.collocations(frame).first()
    finally:
        collocations.frequent_phrases = real
    assert row["score"] == 1000 * huge * 9_000_000_000_019 // ((huge + 2) * (huge + 9))


@pytest.mark.parametrize("seed", range(4))
def test_summary_keeps_every_frequent_value(seed):
    """Counts of any order and cut: values of the threshold or more survive a capacity above mass / threshold."""
    rng = np.random.default_rng(seed)
    values = rng.zipf(1.3, 20000) % 5000
    rng.shuffle(values)
    threshold = 60
    truth = Counter(values.tolist())
    summary = collocations.Summary(len(values) // threshold + 1)
    for part in np.array_split(values.astype(np.uint64), 37):
        summary.merge(*collocations.counted(part))
        assert len(summary.hashes) <= summary.capacity
    kept = dict(zip(summary.hashes.tolist(), summary.counts.tolist()))
    assert summary.taken < threshold
    assert {v for v, c in truth.items() if c >= threshold} <= set(summary.frequent(threshold).tolist())
    assert all(truth[v] - summary.taken <= c <= truth[v] for v, c in kept.items())


def test_packed_numbers():
    for most in (0, 255, 256, 65536, 2 ** 32, 2 ** 63):
        values = np.array([0, 1, most], dtype=np.uint64)
        assert collocations.unpacked(collocations.packed(values), 3).tolist() == values.tolist()
