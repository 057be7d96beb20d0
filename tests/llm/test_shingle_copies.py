"""The near-copy stage against brute-force Jaccard similarity of five-word shingles."""

import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from wardrisk.llm import shingle_copies

import corpus_pipeline

from .conftest import prose
from .test_near_copies import groups


def plain_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_links(sets):
    """All pairs of similar sets; only those that share a shingle are looked at, and equal ones."""
    owners, links = {}, set()
    for i in sorted(sets):
        for shingle in sets[i] or {None}:
            owners.setdefault(shingle, []).append(i)
    for i in sorted(sets):
        shared = Counter(j for shingle in sets[i] or {None} for j in owners[shingle] if j > i)
        links |= {(i, j) for j, n in shared.items() if not sets[i] or n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
    return sorted(links)


def test_stage_keeps_one_of_each_group(spark):
    """Copies at about 0.85 and 0.9 go, most of which differ in more than four bits; at about 0.7 they stay."""
    rng = random.Random(11)
    texts = [None, "", "a b c", "A B C"]
    for n in range(60):
        words = prose(rng, 240).split()
        texts.append(" ".join(words))
        for changed in (4, 2, 9)[n % 3:n % 3 + 1]:
            other = list(words)
            for i in range(changed):
                other[10 + i * (220 // changed)] = f"changed{n}x{i}"
            texts.append(" ".join(other))
    sets = {i: plain_shingles(t) for i, t in enumerate(texts)}
    links = plain_links(sets)
    want = sorted(set(groups(sorted(sets), links).values()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert got == want and len(links) >= 42


def test_group_of_near_copies_is_one(spark):
    """Far more rows with one key than are paired with each other."""
    rng = random.Random(3)
    words = prose(rng, 200).split()
    texts = [" ".join(words[:i] + [f"new{i}"] + words[i + 1:]) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [0]


def test_keys_across_batches():
    """However the sorted rows are cut into batches, all of a key meet, also with more rows than are held."""
    rows = [(1, 5, 50), (1, 7, 70)] + [(2, i % 4, 1000 + i) for i in range(9000)] + [(3, 8, 80), (4, 9, 90), (4, 11, 110)]
    for size in (100, 4096, 10000):
        batches = (pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), (
            pa.int32(), pa.int64(), pa.int64()))], ["key", "fp", "node"]) for i in range(0, len(rows), size))
        out = [r for b in shingle_copies.close_pairs(batches) for r in b.to_pylist()]
        pairs = [(r["a"], r["b"]) for r in out if r["b"] is not None]
        found = groups(sorted(n for _, _, n in rows), pairs)
        assert len(set(found.values())) == 4 and found[9999] == 1000 and len(pairs) < 4 * len(rows)
        # All rows of the large key are passed on, once.
        assert sorted(r["a"] for r in out if r["b"] is None) == list(range(1000, 10000))


def test_rows_of_a_large_key_all_meet(monkeypatch):
    """Every close pair of different groups comes out of the cells, whatever the blocks, and however the rows are batched."""
    rng = random.Random(2)
    rows = [(7, i, i % 3, rng.getrandbits(63) if i % 2 else 12345) for i in range(60)]  # key, node, root, fp
    near = {(a, b) for _, a, x, f in rows for _, b, y, g in rows
            if a < b and x != y and (f ^ g).bit_count() <= shingle_copies.MOST_BITS}
    for n in (1, 4):
        cells = sorted((key, min(node % n, other), max(node % n, other), node % n, node, root, fp)
                       for key, node, root, fp in rows for other in range(n))
        for size in (7, 500):
            batches = (pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells[i:i + size]), (
                pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["key", "low", "high", "own", "node", "root", "fp"]) for i in range(0, len(cells), size))
            found = [(r["a"], r["b"]) for b in shingle_copies.cell_pairs(batches) for r in b.to_pylist()]
            assert sorted(found) == sorted(near)


def test_parities_leave_out_no_similar_pair():
    """Also at exactly 0.8 and for sets of many more shingles than there are bins."""
    rng = np.random.default_rng(5)
    left_out = 0
    for size in (1, 5, 9, 90, 400, 900, 6000):
        for _ in range(60):
            common = int(size * rng.choice([0, 0.6, 0.75, 8 / 9, 8 / 9, 0.95, 1]))
            x, y = (np.unique(rng.integers(0, 1 << 63, size - common + int(rng.integers(0, 2)) * size // 9).astype("<u8")) for _ in range(2))
            both = rng.integers(0, 1 << 63, common).astype("<u8")
            x, y = np.union1d(x, both), np.union1d(y, both)
            shared, total = len(np.intersect1d(x, y)), len(x) + len(y)
            apart = sum((int(a) ^ int(b)).bit_count() for a, b in zip(
                shingle_copies.parities_of(x).view("<u8"), shingle_copies.parities_of(y).view("<u8")))
            assert apart <= total - 2 * shared
            if 10 * shared >= 8 * (total - shared):
                assert shingle_copies.may_be_similar(apart, total)
            elif size < 1000:
                left_out += not shingle_copies.may_be_similar(apart, total)
    assert left_out > 100


def test_texts_of_one_template_make_few_pairs(spark, monkeypatch):
    """Texts that are alike, and yet below 0.8: not all of their pairs come out of the cells and are checked on sets."""
    rng = random.Random(6)
    words, texts = prose(rng, 300).split(), []
    for i in range(120):
        other = list(words)
        for j in rng.sample(range(300), 9):
            other[j] = f"own{i}x{j}"
        texts.append(" ".join(other))
    links = plain_links({i: plain_shingles(t) for i, t in enumerate(texts)})
    counts, real_signs = [], shingle_copies.by_signs

    def counted(pairs, nodes):
        out = real_signs(pairs, nodes)
        counts.append((pairs.count(), out.count()))
        return out

    monkeypatch.setattr(shingle_copies, "by_signs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    want = groups(range(120), links)
    assert sorted(kept) == sorted(set(want.values()))
    (_, near), (more, more_near) = counts
    print(counts, len(links))
    assert more < 700 and near + more_near < 700  # of 7,140 pairs


def test_parities_of_cells_count_the_highest_bit():
    """Sets that differ in the last bin of a word, which is the sign of a signed number, can be similar."""
    words = np.zeros((2, shingle_copies.PARITY_BINS // 64), dtype="<i8")
    words[1, 3] = np.iinfo(np.int64).min + 1  # two bins
    columns = [pa.array([7, 7], pa.int32())] + [pa.array([0, 0], pa.int32())] * 3 + [pa.array(c, pa.int64()) for c in ([1, 2], [1, 2], [5, 5], [90, 90])]
    parity = pa.ListArray.from_arrays(np.array([0, 16, 32], dtype=np.int32), words.ravel())
    batch = pa.RecordBatch.from_arrays(columns + [parity], ["key", "low", "high", "own", "node", "root", "fp", "size", "parity"])
    assert [r for b in shingle_copies.cell_pairs(iter([batch])) for r in b.to_pylist()] == [{"a": 1, "b": 2}]


def test_pairs_of_a_large_group_grow_with_its_texts(spark, monkeypatch):
    """Near copies in many common keys: each text asks for a few others over all of them, and all are one group."""
    rng = random.Random(8)
    words, texts = prose(rng, 160).split(), []
    for i in range(800):
        other = list(words)
        for j in rng.sample(range(160), 2):
            other[j] = f"own{i}x{j}"
        texts.append(" ".join(other))
    counts, real_signs = [], shingle_copies.by_signs

    def counted(pairs, nodes):
        counts.append(pairs.count())
        return real_signs(pairs, nodes)

    monkeypatch.setattr(shingle_copies, "by_signs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [0]
    print(counts)
    assert counts[0] < 30 * len(texts) and sum(counts) < 40 * len(texts)


def test_nearest_ones_are_asked_for_once_where_texts_stand_together(spark, monkeypatch):
    """Near copies have many large keys in common; no text is paired with its nearest ones in each of them anew."""
    rng = random.Random(8)
    words, texts = prose(rng, 160).split(), []
    for i in range(800):
        other = list(words)
        for j in rng.sample(range(160), 2):
            other[j] = f"own{i}x{j}"
        texts.append(" ".join(other))
    near, passed, real = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), shingle_copies.close_pairs

    def counted(batches, *nearest):
        for batch in real(batches, *nearest):
            near.add(batch.num_rows - batch.column("apart").null_count)
            passed.add(batch.column("b").null_count)
            yield batch

    monkeypatch.setattr(shingle_copies, "close_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [0]
    print(near.value, passed.value)
    assert 0 < near.value < 10 * len(texts) < passed.value


def test_put_together_keys_and_others_stay_apart(spark, monkeypatch):
    """Groups of near copies, some put together and some not, are the same ones with any work for a moved row."""
    rng, texts = random.Random(14), []
    for _ in range(6):
        words = prose(rng, 200).split()
        for i in range(30):
            other = list(words)
            for j in rng.sample(range(200), 1 + i % 6):
                other[j] = f"own{len(texts)}x{j}"
            texts.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = sorted(set(groups(range(len(texts)), plain_links({i: plain_shingles(t) for i, t in enumerate(texts)})).values()))
    for moved in (256, -10 ** 6):  # with the latter, no keys are put together
        monkeypatch.setattr(shingle_copies, "MOVED", moved)
        assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == want


def test_texts_of_large_keys_meet_once(spark, monkeypatch):
    """Texts of one template share most of their keys; their rows are compared once, not once for each key."""
    rng = random.Random(6)
    words, texts = prose(rng, 300).split(), []
    for i in range(240):
        other = list(words)
        for j in rng.sample(range(300), 9):
            other[j] = f"own{i}x{j}"
        texts.append(" ".join(other))
    rows, real = spark.sparkContext.accumulator(0), shingle_copies.cell_pairs

    def counted(batches):
        def seen():
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch
        return real(seen())

    monkeypatch.setattr(shingle_copies, "cell_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    want = groups(range(240), plain_links({i: plain_shingles(t) for i, t in enumerate(texts)}))
    assert sorted(kept) == sorted(set(want.values()))
    print(rows.value)
    assert 0 < rows.value < 10 * len(texts)


def test_keys_put_together_lose_no_meeting(spark):
    """Nodes with one key and different roots still have one, and there is no more work than before."""
    rng = random.Random(12)
    rows = {(k, rng.randrange(40)) for k in range(30) for _ in range(25)}  # alike, with many nodes in common
    rows |= {(100 + k, n) for k in range(12) for n in [500, *range(1000 + 20 * k, 1009 + 20 * k)]}  # one node in common
    rows |= {(200, n) for n in range(2000, 2010)}  # all of one root
    roots = {n: 2000 for n in range(2001, 2010)} | {n: n - 1 for n in range(1, 40, 2)}

    def pairs_of(dealt):
        keys = {}
        for k, n in dealt:
            keys.setdefault(k, []).append(n)
        return keys, {(a, b) for x in keys.values() for a in x for b in x if a < b and roots.get(a, a) != roots.get(b, b)}

    out = shingle_copies.meetings(spark.createDataFrame(sorted(rows), "key int, node long").repartition(3),
                                  spark.createDataFrame(sorted(roots.items()), "node long, root long")).collect()
    before, wanted = pairs_of(rows)
    after, found = pairs_of([(r["key"], r["node"]) for r in out])
    assert wanted <= found and 200 not in after
    assert all(r["root"] == roots.get(r["node"], r["node"]) and r["n"] == len(after[r["key"]]) for r in out)
    assert len({(r["key"], r["node"]) for r in out}) == len(out) < len(rows) / 2
    work, work_before = (sum(len(x) * (len(x) + shingle_copies.MOVED) for x in keys.values()) for keys in (after, before))
    assert work <= work_before
    assert any(k < 0 for k in after) and all(100 + k in after for k in range(12))


def test_no_link_is_lost_among_rows_of_one_key(spark):
    """A chain of copies, each like the next one only, in keys of more rows than are paired at once."""
    rng = random.Random(4)
    words = prose(rng, 300).split()
    texts = []
    for i in range(40):
        texts.append(" ".join(words))
        for j in range(3):
            words[(i * 3 + j) * 2 % 290] = f"step{i}x{j}"
    sets = {i: plain_shingles(t) for i, t in enumerate(texts)}
    want = sorted(set(groups(sorted(sets), plain_links(sets)).values()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == want


def test_equal_hash_of_a_row_needs_128_bits(spark, monkeypatch):
    """Two rows with one 64-bit hash are still two rows."""
    docs = spark.createDataFrame([(1, "one text of its own"), (2, "quite another text here")], "doc_id long, text string")
    real = corpus_pipeline.F.xxhash64
    monkeypatch.setattr(corpus_pipeline.F, "xxhash64", lambda *c: real(*c) if len(c) > len(docs.columns) else F.lit(5).cast("long"))
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == 2


SF_DIR = os.environ.get("TEST_RECALL_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_recall_on_the_tables(spark):
    """Of all pairs of different similar sets among the documents, nine in ten at least are in one group, and no other pair is."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    # Changed copies of some of them beside the table's own, at 0.8 to 0.95.
    rng, texts = random.Random(9), {r["doc_id"]: r["text"] for r in rows}
    for i, text in list(texts.items())[:300]:
        words = (text or "").split(" ")
        for at in rng.sample(range(len(words)), min(len(words) // 60 + 1, len(words))):
            words[at] = f"changed{i}"
        texts[10 ** 6 + i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    hashed = frame.withColumns({"r1": F.xxhash64("doc_id"), "r2": F.col("doc_id")})
    found = {r["doc_id"]: r["component"] for r in shingle_copies.near_copies(hashed, ("r1", "r2")).join(
        hashed.select("r1", "r2", "doc_id"), ["r1", "r2"]).collect()}
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    links = plain_links(sets)
    different = [(a, b) for a, b in links if sets[a] != sets[b]]
    met = sum(found[a] == found[b] for a, b in different)
    print(f"{met} of {len(different)} pairs")
    assert len(different) > 100 and met >= 0.9 * len(different)
    assert all(found[a] == found[b] for a, b in links if sets[a] == sets[b])
    want = groups(sorted(sets), links)
    together = {}
    for i, c in found.items():
        together.setdefault(c, set()).add(want[i])
    assert all(len(g) == 1 for g in together.values())
