"""BPE, packing and training order: against the libraries, exact round trips and plain packing."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from wardrisk.llm import bpe, packing, training_order
from wardrisk.llm.lexicon import Lexicon, compile_lexicon
from wardrisk.llm.shared import byte_encoder, vocabulary_file


def library(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_file(name))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def test_bpe(docs, corpus, empty):
    tokenizer = library(bpe.VOCABULARY)
    want = {}
    for i, text in corpus:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    for most in (bpe.LEXICON_WORDS, 0):
        assert {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(docs, most=most).collect()} == want
    texts = {i: t or "" for i, t in corpus}
    rows = bpe.encode_and_decode(docs).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == texts
    assert bpe.digests(empty).collect() == []


def test_long_words_merge_alike():
    vocab = bpe.vocabulary(vocabulary_file(bpe.VOCABULARY))
    tokenizer = library(bpe.VOCABULARY)
    for word in ("a" * 500, "abcab" * 60, "the" * 90, "é" * 200):
        assert vocab.merge(word.encode()) == tokenizer.encode(word, add_special_tokens=False).ids


def test_lexicon(tmp_path):
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"a", b"\xc3\xa9t\xc3\xa9", b"x" * 60]
    path = str(tmp_path / "lexicon")
    compile_lexicon([(w, [i, i + 1]) for i, w in enumerate(words)], path)
    lexicon = Lexicon(path)
    found = lexicon.find(words + [b"", b"ta", b"tapss", b"zebra"])
    assert [np.frombuffer(f, "<u4").tolist() for f in found[:8]] == [[i, i + 1] for i in range(8)]
    assert found[8:] == [None] * 5  # too long, and not there
    assert len(lexicon.accepting) < 20  # suffixes are shared: a trie would need 26 states
    assert lexicon.find([b"y" * 60]) == [None]
    compile_lexicon([], path)
    assert Lexicon(path).find([b"a"]) == [None]


def plain_best_fit(lengths, size):
    """Best-fit decreasing, piece by piece."""
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(size - n)
    return sorted(free)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([7, 16, 50, 64]))
    lengths = rng.integers(1, size + 1, int(rng.integers(1, 300))).tolist()
    steps, used = packing.plan(Counter(lengths), size), defaultdict(list)
    for length, n in Counter(lengths).items():
        own = steps[steps[:, 0] == length]
        for rank in range(n):
            _, first, each, sequence, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            used[int(sequence + (rank - first) // each)].append((int(offset + (rank - first) % each * length), length))
    free = []
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        free.append(size - at)
    assert sorted(free) == plain_best_fit(lengths, size)


def test_capacities():
    tree = packing.Capacities(10)
    assert tree.tightest(1) is None
    for capacity in (3, 7, 7, 10):
        tree.add(capacity, 1)
    assert [tree.tightest(n) for n in range(1, 11)] == [3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    tree.add(3, -1)
    assert tree.tightest(1) == 7


def test_packing(docs, corpus, empty):
    tokenizer = library(packing.VOCABULARY)
    want = {}
    for i, text in corpus:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for number, start in enumerate(range(0, len(ids), 64)):
            own = np.array(ids[start:start + 64], "<u4")
            want[i, number] = (start, len(own), zlib.crc32(own.tobytes()))
    rows = packing.pack(docs, size=64).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) == len(plain_best_fit([v[1] for v in want.values()], 64))
    assert packing.pack(empty).collect() == []


def test_permutation():
    for n in (1, 2, 3, 100, 4097):
        order = training_order.Permutation(n, key=9)
        slots = order.slots(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n))
        assert order.sequences(slots).tolist() == list(range(n))
    first, second = (training_order.Permutation(1000, key=k).slots(np.arange(1000)) for k in (1, 2))
    assert (first != second).mean() > 0.9 and (first == training_order.Permutation(1000, key=1).slots(range(1000))).all()


def test_shards_are_written_in_slot_order(spark, tmp_path):
    """Also if the rows of a shard come in another order, as the writer's own sort may leave them."""
    ids = {slot: bytes([65 + slot % 26, 0]) * 4 for slot in range(40)}
    rows = [(s, s // 16, ids[s]) for s in sorted(ids, reverse=True)]
    path = str(tmp_path / "shards")
    training_order.write_shards(spark.createDataFrame(rows, "slot long, shard long, ids binary").coalesce(1), path)
    assert {r["slot"]: r["ids"] for r in training_order.read_shards(spark, path, 4, 16).collect()} == ids


def test_training_order(spark, docs, corpus, empty, tmp_path):
    records = training_order.training_order(docs, size=32, shard_rows=16).cache()
    rows = sorted(records.collect(), key=lambda r: r["slot"])
    n = len(rows)
    order = training_order.Permutation(n)
    assert [r["slot"] for r in rows] == list(range(n))
    assert order.slots([r["sequence"] for r in rows]).tolist() == list(range(n))
    assert all((r["shard"], r["byte_offset"]) == (r["slot"] // 16, r["slot"] % 16 * 66) for r in rows)
    by_sequence = sorted(rows, key=lambda r: r["sequence"])
    stream = [i for r in by_sequence for i in np.frombuffer(r["ids"], "<u2")[:r["n_tokens"]].tolist()]
    encoder = byte_encoder(vocabulary_file(training_order.VOCABULARY))
    want = Counter(tuple(encoder.encode_ordinary(t or "")) for _, t in corpus)
    got, document = Counter(), []
    for i in stream:
        if i == training_order.END_ID:
            got[tuple(document)] += 1
            document = []
        else:
            document.append(i)
    assert got == want and not document
    path = str(tmp_path / "shards")
    training_order.write_shards(records, path)
    for start in (0, 16, 21, n - 1):
        back = training_order.read_shards(spark, path, 32, 16, start).collect()
        assert {r["slot"]: r["ids"] for r in back} == {r["slot"]: r["ids"] for r in rows[start:]}
    assert training_order.training_order(empty).collect() == []
    training_order.write_shards(training_order.training_order(empty), str(tmp_path / "none"))
    assert training_order.read_shards(spark, str(tmp_path / "none")).collect() == []


def test_materialised_order(spark, docs, empty, tmp_path, monkeypatch):
    """What is read back from the shards is what was to be written, from any slot; tasks hold a few shards each."""
    monkeypatch.setattr(training_order, "SHARDS_A_TASK", 2)
    records = training_order.training_order(docs, size=32, shard_rows=16)
    want = sorted(tuple(r) for r in records.collect())
    parts = {r["shard"]: r["p"] for r in records.select("shard", F.spark_partition_id().alias("p")).distinct().collect()}
    assert parts == {shard: shard // 2 for shard in parts} and len(parts) > 10
    path = str(tmp_path / "order")
    training_order.materialise(docs, path, size=32, shard_rows=16)
    for start in (0, 17, len(want) - 1):
        assert sorted(tuple(r) for r in training_order.materialised(spark, path, start).collect()) == want[start:]
    shard = next((tmp_path / "order/shards/shard=3").glob("part-*"))
    assert shard.stat().st_size == 16 * 66  # fixed stride
    training_order.materialise(empty, str(tmp_path / "none2"))
    assert training_order.materialised(spark, str(tmp_path / "none2")).collect() == []
