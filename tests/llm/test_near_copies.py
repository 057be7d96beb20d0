"""SimHash, components, suffix arrays and the removal of passages: against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import xxhash
from wardrisk.llm import simhash, suffix_dedup
from wardrisk.llm.components import connected_components
from wardrisk.llm.suffix_array import common_prefixes, suffix_array


def plain_fingerprint(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_near_copies(docs, corpus):
    prints = {i: plain_fingerprint(t) for i, t in corpus}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = groups(sorted(prints), links)
    rows = simhash.near_copies(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert len(set(want.values())) < len(want)


def test_near_copies_null_ids_and_repeats(spark, empty):
    rows = [(None, "one two three four five"), (None, "one two three four five"), (4, "one two three four five"),
            (4, "one two three four five"), (None, "nothing like the others at all"), (9, None), (7, " ")]
    out = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == [
        (-1, -1), (-1, 4), (-1, 4), (4, 4), (4, 4), (7, 7), (9, 7)]
    assert simhash.near_copies(empty).collect() == []


def test_golay_keys_meet():
    """Every code of up to four flipped bits shares a key; each key comes once per code."""
    rng = np.random.default_rng(3)
    base = rng.integers(-2 ** 63, 2 ** 63 - 1, 400)
    for flips in range(5):
        masks = [sum(1 << int(b) for b in rng.choice(64, flips, replace=False)) for _ in base]
        other = base ^ np.array(masks, dtype=np.uint64).view(np.int64)
        a, b = (list(zip(*(x.tolist() for x in simhash.keys_of(v)))) for v in (base, other))
        assert len(a) == len(set(a))
        assert {row for row, _ in set(a) & set(b)} == set(range(len(base)))


def test_golay_decoding_is_perfect():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 23, 2000)
    _, errors = simhash.golay_tables()
    assert len(set(errors.tolist())) == 2048 and max(int(e).bit_count() for e in errors) == 3
    rows, _ = simhash.nearby_indices(values)
    assert set(np.bincount(rows).tolist()) <= {1, 6}


def test_large_keys_go_in_blocks(spark):
    """A ball of fingerprints around one code: far more rows with one key than a block."""
    center = 0x123456789ABCDEF
    ball = [center ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(40), 2)]
    far = [center ^ (1 << 50) ^ (1 << 51) ^ (1 << 52) ^ (1 << 53) ^ (1 << 54) ^ (1 << 55) ^ (1 << 56) ^ (1 << 57)]
    nodes = spark.createDataFrame([(f,) for f in ball + far], "fp long")
    for block in (16, 4096):
        roots = connected_components(simhash.fingerprint_edges(nodes, block=block)).collect()
        assert {r["root"] for r in roots} == {min(ball)} and len(roots) == len(ball) - 1


def test_keys_across_batches():
    """However the sorted rows are cut into batches, a large key passes whole and a small one is compared."""
    import pyarrow as pa

    rows = [(1, 5), (1, 7)] + [(2, 1000 + i) for i in range(90)] + [(3, 8), (4, 9), (4, 11)] + [(5, 4096 * i) for i in range(40)]
    for size in (1, 3, 7, 50, 500):
        batches = (pa.RecordBatch.from_arrays([pa.array([k for k, _ in part]), pa.array([f for _, f in part])], ["key", "fp"])
                   for part in (rows[i:i + size] for i in range(0, len(rows), size)))
        out = [r for b in simhash.compare_keys(batches, 4, 60) for r in b.to_pylist()]
        assert sorted((r["key"], r["b"]) for r in out if r["key"] is not None) == rows[2:92]
        edges = [(r["a"], r["b"]) for r in out if r["key"] is None]
        nodes = [f for k, f in rows if k != 2]
        links = [(a, b) for k, a in rows for m, b in rows if k == m != 2 and a < b and (a ^ b).bit_count() <= 4]
        assert groups(sorted(nodes), edges) == groups(sorted(nodes), links)


def test_components(spark, rows):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, k) for k in range(100, 190)]
    edges += [(rng.randint(0, 99), rng.randint(0, 99)) for _ in range(60)] + [(3, 3)]
    want = groups({n for e in edges for n in e}, edges)
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in out} == {n: r for n, r in want.items() if n != r}


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 70))
        text = rng.integers(0, rng.choice([1, 2, 3, 255]) + 1, n).astype(np.uint8)
        data = text.tobytes()
        order = suffix_array(text, 80)
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
        shared = [len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(data[a:], data[b:]))))
                  for a, b in zip(order, order[1:])]
        assert common_prefixes(text, order, 80).tolist() == [0] + shared
        assert common_prefixes(text, order, 5).tolist() == [0] + [min(5, s) for s in shared]


def plain_removal(rows, length=100):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            window = data[start:start + length]
            if window in seen:
                gone[start:start + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def removal(docs):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in suffix_dedup.without_repeats(docs, ("doc_id",)).collect()}


def test_removal_of_passages(docs, corpus):
    want = plain_removal(corpus)
    assert removal(docs) == want
    assert sum(v[1] for v in want.values()) > 5000


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(5)]
    for i in range(n):
        text = rng.choice(["", "a" * 400, "ab" * 300, "x" * 99, "x" * 100]) if rng.random() < 0.1 else " ".join(
            rng.choice(words) for _ in range(rng.randint(0, 60)))
        for _ in range(rng.randint(0, 2)):
            p, cut = rng.choice(passages), rng.randint(0, len(text))
            start = rng.randint(0, len(p) - 60)
            text = text[:cut] + p[start:start + rng.randint(60, 220)] + text[cut:]
        yield i, text


def test_removal_with_minimizers_sent_window_by_window(spark, monkeypatch):
    rows = list(random_texts(3, 150))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_removal(rows)
    assert removal(docs) == want
    monkeypatch.setattr(suffix_dedup, "LARGE_BYTES", 300)
    assert removal(docs) == want


def test_parts_of_a_long_document(monkeypatch):
    """Small buffers, small reductions and small arrays give the same windows."""
    import pyarrow as pa

    text = ("".join(t for _, t in random_texts(9, 30)) * 2).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([text])], ["ord", "tie", "body"])
    monkeypatch.setattr(suffix_dedup, "BUFFER_BITS", 10)
    whole = {r: 0 for r in range(len(text) - 99)}
    for out in suffix_dedup.document_pieces([batch], 100):
        for r in out.to_pylist():
            if r["content"] is not None:
                for k in range(r["n"]):
                    whole[r["start"] + k] += 1
            else:
                for k in range(r["n"] - 99):
                    whole[r["start"] + k] += 1
    assert all(whole.values())


def test_removal_null_ids_and_repeats(spark, empty):
    text = "".join(chr(97 + i % 26) + str(i) for i in range(100))
    rows = [(None, text), (3, text), (3, text), (5, text + "tail"), (None, None)]
    out = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ("doc_id",)).collect()
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in out)
    n = len(text)
    assert got == [(-1, 0, 0), (-1, n, n), (3, n, 0), (3, n, 0), (5, n + 4, n)]
    assert suffix_dedup.without_repeats(empty, ("doc_id",)).collect() == []


def texts_of_one_checksum():
    """Two texts of 220 bytes with one CRC-32, of which each has nothing twice."""
    seen = {}
    for i in range(400_000):
        text = "".join(chr(97 + (i * 7 + k * k + (i >> k % 13)) % 26) for k in range(12)) + f"{i:08d}"
        own = zlib.crc32((text + "x" * 0).encode())
        if own in seen and seen[own] != text:
            return seen[own], text
        seen[own] = text
    raise AssertionError("no pair found")


def test_texts_with_one_checksum_are_two(spark):
    first, second = texts_of_one_checksum()
    rng = random.Random(12)
    # Equal bytes before two texts of one checksum leave the checksums equal.
    passage = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(180))
    a, b = passage + first, passage + second
    assert zlib.crc32(a.encode()) == zlib.crc32(b.encode()) and a != b
    for ids, kind in (((None, None), "long"), ((4, 4), "long"), (("x", "x"), "string")):
        docs = spark.createDataFrame([(ids[0], a), (ids[1], b)], f"doc_id {kind}, text string")
        rows = suffix_dedup.without_repeats(docs, ("doc_id",)).collect()
        # One of them keeps all, the other loses the passage alone.
        assert sorted(r["n_removed"] for r in rows) == [0, 180 + common_start(first, second)]
        assert {r["kept_text"] for r in rows} & {a, b}


def common_start(a, b):
    return next(i for i in range(len(a) + 1) if a[:i + 1] != b[:i + 1])


def test_ids_of_any_type_and_nulls_last(spark):
    rng = random.Random(13)
    passage = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(150))
    for ids, kind in ((["b", "a", None], "string"), ([2.5, 1.5, None], "double"), ([7, 3, None], "int")):
        docs = spark.createDataFrame([(i, f"{k}{passage}{k}") for k, i in enumerate(ids)], f"doc_id {kind}, text string")
        removed = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.without_repeats(docs, ("doc_id",)).collect()}
        assert sorted(removed.values()) == [0, 150, 150] and removed[None] == 150
        if kind == "int":
            assert removed == {3: 0, 7: 150, None: 150}


def test_texts_are_moved_once(spark):
    """The shared pieces fetch their bytes from the same exchange of the texts that the removal uses."""
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage = "".join(rng.choices(letters, k=250))
    rows = [(i, f"{''.join(rng.choices(letters, k=150))} {passage[i % 7:]} {''.join(rng.choices(letters, k=150))}", f"source {i}") for i in range(40)] + [(None, passage, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for columns in (("doc_id",), ("source", "doc_id")):
            found = suffix_dedup.without_repeats(docs, columns)
            assert found.where("n_removed > 0").count() > 30
            found.collect()
            plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
            moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(ord" in line and "ReusedExchange" not in line]
            assert "ReusedExchange" in plan and len(moved) == 4  # the texts once; numbers of pieces, distinct spans and all of a text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
