"""Token histogram, quality rules, licences: against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
from wardrisk.llm import license_scan, quality_rules, token_counts
from wardrisk.llm.shared import byte_encoder, vocabulary_file


def lengths(corpus):
    encoder = byte_encoder(vocabulary_file(token_counts.VOCABULARY))
    return [len(encoder.encode_ordinary(t or "")) for _, t in corpus]


def test_length_histogram(docs, corpus):
    want = lengths(corpus)
    histogram = token_counts.length_histogram(token_counts.token_lengths(docs)).cache()
    rows = {r["n_tokens"]: r for r in histogram.collect()}
    assert {k: r["n_docs"] for k, r in rows.items()} == Counter(want)
    for n, r in rows.items():
        assert r["docs_at_least"] == sum(x >= n for x in want)
        assert r["tokens_at_least"] == sum(x for x in want if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in want)
        assert abs(r["share_up_to"] - sum(x <= n for x in want) / len(want)) < 1e-12
    limits = [0, 1, 100, 101, 2500, 10 ** 6]
    for r in token_counts.at_limits(histogram, limits).collect():
        c = r["context"]
        assert (r["docs_cut"], r["tokens_kept"], r["tokens_lost"]) == (
            sum(x > c for x in want), sum(min(x, c) for x in want), sum(max(0, x - c) for x in want))
    for r in token_counts.quantiles(histogram, [0.0, 0.5, 0.9, 1.0]).collect():
        assert r["n_tokens"] == sorted(want)[max(0, int(np.ceil(r["share"] * len(want))) - 1)]


def test_length_histogram_of_nothing(empty):
    histogram = token_counts.length_histogram(token_counts.token_lengths(empty))
    assert histogram.collect() == []
    assert [tuple(r) for r in token_counts.at_limits(histogram, [5]).collect()] == [(5, 0, 0, 0)]


def base_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed)


def test_quality_rules(docs, corpus):
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs).collect()}
    assert len(rows) == len(corpus)
    for i, text in corpus:
        r = rows[i]
        assert tuple(r[1:7]) == base_rules(text)
        assert not (r["base_failed"] and r["kept"])
    clean = [i for i, t in corpus if i < 60 and not rows[i]["base_failed"]]
    assert clean and all(rows[i]["kept"] for i in clean)


def test_quality_bands(spark):
    symbols = " ".join(w + "$$$" for w in ["one", "two"] * 10 + [f"w{i}" for i in range(60)])
    byte_words = " ".join("ᚠᚡᚢ" + chr(0x16a3 + i) for i in range(60))
    docs = spark.createDataFrame([(1, symbols), (2, byte_words)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs).collect()}
    assert 0.85 < rows[2]["byte_fallback"] < 1.0  # three bytes for each rune, and a piece for each space
    assert rows[2]["script"] == "other" and not rows[2]["kept"]
    assert quality_rules.script_of({"д": 3, "a": 2}) == "cyrillic"
    assert quality_rules.script_of({"1": 5}) == "none"
    strict = {"latin": quality_rules.Band(20.0, 30.0, 0, 0, 0, 0), "other": quality_rules.BANDS["other"]}
    assert not any(r["kept"] for r in quality_rules.apply_rules(docs, bands=strict).collect())


def measures(text):
    """Characters per token, byte-fallback share and token entropy, by the libraries over the whole text."""
    import sentencepiece

    ids = byte_encoder(vocabulary_file(quality_rules.TOKENS)).encode_ordinary(text or "")
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file(quality_rules.PIECES))
    pieces = model.encode(text or "")
    bits = -sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values())
    return (len(text or "") / max(len(ids), 1), sum(map(model.is_byte, pieces)) / max(len(pieces), 1), bits)


def test_measures_and_verdicts(spark, docs, corpus):
    """All measures by the libraries, and what they and the bands make of ``kept``; also of odd spaces and of a text of some MB."""
    rng = random.Random(3)
    odd = [(1000 + i, "".join(rng.choice(" ab\n ﬁ①Å日ᚠ \t.é\xa0") for _ in range(rng.randrange(20)))) for i in range(200)]
    odd += [(2000, " "), (2001, "   "), (2002, "ﬁ ① Å"), (2003, " a  b "), (2004, "one two three. " * 150_000)]
    extra = spark.createDataFrame(odd, "doc_id long, text string")
    rows = {r["doc_id"]: r for part in (docs, extra) for r in quality_rules.apply_rules(part).collect()}
    for i, text in corpus + odd:
        r, (chars, share, bits) = rows[i], measures(text)
        assert abs(r["chars_per_token"] - chars) < 1e-9 and abs(r["byte_fallback"] - share) < 1e-12 and abs(r["token_entropy"] - bits) < 1e-6
        tokens = len(byte_encoder(vocabulary_file(quality_rules.TOKENS)).encode_ordinary(text or ""))
        band = quality_rules.BANDS[r["script"]]
        inside = (band.least_chars <= chars <= band.most_chars and share <= band.most_fallback
                  and bits >= min(band.top, band.base + band.slope * math.log2(max(tokens, 1))))
        assert r["kept"] == (inside and not r["base_failed"])


def test_quality_rules_of_nothing(empty):
    assert quality_rules.apply_rules(empty).collect() == []


def test_licences(docs, corpus):
    rows = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in corpus:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        places, labels = [], set()
        for phrase in license_scan.BASE:
            own = phrase.words.split()
            found = [k for k in range(len(words)) if words[k:k + len(own)] == own]
            places += found
            labels |= {phrase.label} if found else set()
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_label_holds_beside_a_hot_source(spark):
    """A third of the rows have the phrase without a version; neither they nor the others change their labels."""
    texts = ["Under the GNU General Public License as published."] * 40 + ["GNU General Public License version 3"] * 2
    texts += ["nothing of the kind here", "another text"] * 40
    for part in (texts, texts[:1] + texts[40:], texts[39:43]):
        docs = spark.createDataFrame(list(enumerate(part)), "doc_id long, text string")
        rows = license_scan.scan(docs).collect()
        assert {r["doc_id"] for r in rows if r["labels"] == "gpl"} == {i for i, t in enumerate(part) if "GNU" in t}


def plain_labels(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    labels = set()
    for template in (*license_scan.BASE, *license_scan.METHOD):
        whole, own = template.words.split(), (template.mandatory or template.words).split()
        assert any(whole[k:k + len(own)] == own for k in range(len(whole)))
        if any(words[k:k + len(own)] == own for k in range(len(words))):
            labels.add(template.label)
    return ",".join(sorted(labels))


def test_labels_are_the_same_in_any_corpus(spark):
    """Every template whole, its phrase alone, the phrase without its last word, and a mixture, beside three other corpora."""
    rng = random.Random(6)
    texts = []
    for template in license_scan.METHOD:
        phrase = template.mandatory or template.words
        texts += [template.words.capitalize(), f"see the {phrase}!", " ".join(phrase.split()[:-1]) + " unlike it", phrase.replace(" ", " and ")]
    words = license_scan.licence_words(license_scan.METHOD)
    texts += [" ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    texts.append("Permission is hereby granted free of charge to the reader")
    want = [plain_labels(t) for t in texts]
    assert len(set(want)) > 8
    for others in ([], ["nothing of the kind here"] * 200, ["obtaining a copy any person to gnu public license software"] * 200):
        docs = spark.createDataFrame(list(enumerate(texts + others)), "doc_id long, text string")
        rows = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
        assert [rows[i]["labels"] for i in range(len(texts))] == want
        whole = [rows[i]["score"] for i in range(0, 4 * len(license_scan.METHOD), 4)]
        assert whole == [1.0] * len(whole) and all((rows[i]["score"] > 0) == bool(want[i]) for i in range(len(texts)))


def test_licence_templates(spark, empty):
    texts = ["This program is under the GNU General Public License, version 3.",
             "Permission is hereby granted, free of charge, to any person obtaining a copy",
             "Permission is hereby granted free of charge to the reader", "gnu license public general version 3",
             "under the mİt license, under the MIT  license", "cc by nc by nc cc by nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert [rows[i]["labels"] for i in range(6)] == ["gpl", "mit", "", "", "mit", "cc-by-nc"]
    assert (rows[4]["n_base"], rows[4]["first_word"]) == (1, 4)
    assert (rows[5]["n_base"], rows[5]["last_word"]) == (2, 5)
    assert rows[3]["score"] == 0.0
    assert license_scan.scan(empty).collect() == []


def test_windows_with_one_hash_are_compared():
    """Words whose hashes are equal are still different words; without a repeated window none is held as an object."""
    class Word(bytes):
        __hash__ = lambda self: 1

    words = [Word(x) for x in b"a b c d a b c e f e f e f g".split()]
    windows = list(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(windows) if sum(bytes(a) == bytes(b) and bytes(c) == bytes(d) and bytes(e) == bytes(f)
                                                           for (a, c, e), (b, d, f) in ((w, x) for x in windows)) > 1 for j in range(3)}
    assert quality_rules.repeated_words(words) == len(covered) == 12
    assert [quality_rules.repeated_words(x.split()) for x in (b"", b"a", b"a b", b"a b c", b"a a a", b"a a a a")] == [0, 0, 0, 0, 0, 4]


def test_pieces_stay_an_array(monkeypatch):
    """The pieces of a text are never a list of Python numbers."""
    pieces = quality_rules.Pieces(vocabulary_file(quality_rules.PIECES))
    known, model = ["", " ", "plain words", "line\nline", "日本語 ﬁ ᄀ"], pieces.model
    want = [sum(map(model.is_byte, ids)) / max(len(ids), 1) for ids in map(model.encode, known)]
    monkeypatch.setattr(type(model), "encode", lambda *_, **__: 1 / 0)
    assert [pieces.share(x) for x in known] == want
