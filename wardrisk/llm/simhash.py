"""Near copies by SimHash, found with fuzzy hashing on the binary Golay code.

A 64-bit fingerprint has segments of 23, 23 and 18 bits.  The Golay code of length 23 is perfect:
each segment value decodes to the index of the one codeword within distance 3, and values at most 2
apart share a codeword index among the decodings of themselves and of their 23 neighbours (one or
six indices each).  Values at most 1 apart: the index of the one is among those of the other.

Four differing bits over three segments leave a pair of segments with two at most.  So two linked
fingerprints agree on one of nine keys: a whole segment and a shared index of another (six ordered
pairs), or an own index and a neighbour's index crosswise (three pairs).  Rows with one key are
compared exactly; each key yields edges to the least member of every group it connects, never all
pairs.  Keys with more rows than a task should hold are dealt out in blocks and compared block by
block, so no link is lost.

Defined results: a null text or one without words has fingerprint zero; a text shorter than a
shingle is one shingle; equal fingerprints are one node, whatever their number; null ids take part,
and a component without any id has a null component_id; repeated rows give repeated results; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import cut, slices, stored, texts_of

SHINGLE, SEED, MOST_BITS = 4, 42, 4
#: Rows of a key that one task holds and compares; larger keys are dealt out in blocks of about this size.
BLOCK = 4096
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the binary Golay code (fixed value): x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash over word shingles; a bit is set if more than half of the hashes have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # only A-Z change; six characters part words
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*[itertools.islice(words, i, None) for i in range(width)]))
    total, counts = 0, np.zeros(64, dtype=np.int64)
    while block := list(itertools.islice(shingles, 65536)):
        hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in block], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` of the documents and their fingerprint ``fp``."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = pa.array([fingerprint(x) for x in texts_of(batch, "hashed_text")], pa.int64())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [values], list(columns) + ["fp"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + ["fp long"])
    return docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("string").alias("hashed_text")
                       ).mapInArrow(hashed, schema)


@functools.lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of the upper twelve bits, and the error pattern of each syndrome."""
    rest = np.zeros(1 << 12, dtype=np.int64)
    for high in range(1 << 12):
        value = high << 11
        for bit in range(22, 10, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - 11)
        rest[high] = value
    errors = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(4):
        for bits in itertools.combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            errors[(pattern & 0x7FF) ^ rest[pattern >> 11]] = pattern
    return rest, errors


def codeword_index(values: np.ndarray) -> np.ndarray:
    """The twelve message bits of the codeword nearest to each 23-bit value."""
    rest, errors = golay_tables()
    return (values ^ errors[(values & 0x7FF) ^ rest[values >> 11]]) >> 11


def nearby_indices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``values`` and the distinct codeword indices of each value and its 23 neighbours."""
    flips = np.concatenate([[0], 1 << np.arange(23)])
    indices = np.sort(codeword_index(values[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(indices.shape, dtype=bool)
    first[:, 1:] = indices[:, 1:] != indices[:, :-1]
    return np.nonzero(first)[0], indices[first]


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of signed fingerprints: positions and keys, each pair once."""
    unsigned = fps.view(np.uint64)
    parts = [(unsigned >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    own, near = [codeword_index(p) for p in parts], [nearby_indices(p) for p in parts]
    rows, keys, kind = [], [], 0
    for x, y in itertools.permutations(range(3), 2):  # x agrees, y differs in two bits at most
        at, index = near[y]
        rows.append(at)
        keys.append(kind << 36 | parts[x][at] << 12 | index)
        kind += 1
    for x, y in itertools.combinations(range(3), 2):  # one bit differs in either, at most
        at, index = near[y]
        rows.append(at)
        keys.append(kind << 36 | own[x][at] << 12 | index)
        at, index = near[x]
        other = index != own[x][at]  # the pair of own indices is there already
        rows.append(at[other])
        keys.append(kind << 36 | index[other] << 12 | own[y][at[other]])
        kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def link_stars(fps: np.ndarray, most_bits: int) -> tuple[list, list]:
    """Members and the first of each group that links within ``most_bits`` connect; groups of one are left out."""
    members, roots, left = [], [], fps
    while len(left) > 1:
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            close = np.bitwise_count(left ^ todo.pop()) <= most_bits
            if close.any():
                found, left = left[close], left[~close]
                todo.extend(found)
                members.append(found)
                roots.append(np.full(len(found), root))
    return members, roots


def compare_keys(batches: Iterator[pa.RecordBatch], most_bits: int, limit: int | None) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, fp)`` sorted by key to edges ``(a, b, null)``; rows of keys over the limit pass as ``(null, fp, key)``."""
    def edges(a, b, key=None):
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()) if a is not None else pa.nulls(len(b), pa.int64()), pa.array(b, pa.int64()),
             pa.array(key, pa.int64()) if key is not None else pa.nulls(len(b), pa.int64())], ["a", "b", "key"])

    def groups(keys, fps):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        few = np.repeat((sizes > 1) & (sizes <= 8), sizes)
        k, f = keys[few], fps[few]
        for shift in range(1, 8):  # all pairs of the small groups, at once
            if len(k) <= shift:
                break
            hit = (k[shift:] == k[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= most_bits)
            if hit.any():
                yield edges(f[shift:][hit], f[:-shift][hit])
        for start, size in zip(starts[sizes > 8], sizes[sizes > 8]):
            if limit and size > limit:
                yield edges(None, fps[start:start + size], keys[start:start + size])
                continue
            members, roots = link_stars(np.sort(fps[start:start + size]), most_bits)
            if members:
                yield edges(np.concatenate(members), np.concatenate(roots))

    keys, fps, passing = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        fps = np.concatenate([fps, batch.column("fp").to_numpy()])
        if passing is not None:  # the key is known to be over the limit
            n = int(np.searchsorted(keys, passing, side="right"))
            yield edges(None, fps[:n], keys[:n])
            keys, fps = keys[n:], fps[n:]
            passing = None if len(keys) else passing
        if len(keys):
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from groups(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if limit and len(keys) > limit:
                yield edges(None, fps, keys)
                passing, keys, fps = keys[-1], keys[:0], fps[:0]
    if len(keys):
        yield from groups(keys, fps)


def fingerprint_edges(distinct: DataFrame, most_bits: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints ``fp`` to edges ``(a, b)`` whose components are those of all links."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8192):
            fps = batch.column("fp").to_numpy()
            rows, keys = keys_of(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], ["key", "fp"])

    def compared(rows: DataFrame, limit: int | None) -> DataFrame:
        return (rows.repartition("key").sortWithinPartitions("key")
                .mapInArrow(lambda batches: compare_keys(batches, most_bits, limit), "a long, b long, key long"))

    found = stored(compared(distinct.mapInArrow(keyed, "key long, fp long"), block), "links")
    large = found.where("key IS NOT NULL").select("key", F.col("b").alias("fp"))
    parts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"))
    own = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("n")).cast("int")
    cells = (large.join(parts, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).where("own <> other OR n = 1")
             .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp"))
    return found.where("key IS NULL").select("a", "b").unionByName(compared(cells, None).select("a", "b"))


def near_copies(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text",
                most_bits: int = MOST_BITS) -> DataFrame:
    """``columns`` of each document, its ``fingerprint``, ``component`` (a fingerprint of it) and ``component_id``."""
    known = stored(fingerprints(docs, columns, text), "fingerprints")
    nodes = known.groupBy("fp").agg(F.min(columns[0]).alias("least_id"))
    roots = connected_components(fingerprint_edges(nodes.select("fp"), most_bits))
    rooted = cut(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                 .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    lookup = rooted.join(ids, "root").select("fp", F.col("root").alias("component"), "component_id")
    return known.join(lookup, "fp").select(
        *[F.col(f"`{c}`") for c in columns], hex_digits(F.col("fp")).alias("fingerprint"), "component_id",
        hex_digits(F.col("component")).alias("component"))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
