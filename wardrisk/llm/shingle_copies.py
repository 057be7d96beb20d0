"""Near copies by the Jaccard similarity of word shingles, found with soft-decoded Golay keys of a SimHash.

Texts are linked if their sets of five-word shingles have a similarity of 0.8 or more.  At 0.8 some ten of 64
sign bits differ, too many for keys over hard bits.  So the signed sums of a SimHash are decoded, not their
signs: each of six segments of 23 sums goes to the three codewords of the Golay code of length 23 that correlate
most with it, and two texts meet if they share a codeword in two segments.  Which pairs meet is a matter of chance:
``tests/llm/test_shingle_copies.py`` measures it on the tables, and the README has the figures.

Of the texts that meet no pair is left out, however many share a key.  In a key with few texts all pairs are made.  Alike
texts share many keys, so a larger key is put together with the largest one of any of its texts where that is no more work:
each text stands there once, not once for each key.  There each text is first paired with the nearest of those before it, of
which the nearest ones are checked and joined to groups: so many for each text, however large the group.  Then all pairs that
stand together and are not yet in one group are made and checked as well.  A large group of copies is one group by then and
makes no more pairs.  For this the texts are dealt out in blocks, and every block meets every other.

A pair is checked in three steps: by 192 sign bits, of which copies at 0.8 differ in some thirty and others in about half;
by the parities of 1,024 bins of the hashed shingles, in which two sets differ at most as often as they have shingles that
the other lacks, so that no similar pair is left out; and then on the sets.  Only pairs that pass all link.  The rows of
large keys carry the parities: texts of one template that are near by signs and yet below 0.8 make no pairs there.

Defined results: texts with equal sets (128 bits of their hash) are one node, whatever their number; a text shorter than a
shingle is one shingle; a null text or one without words has no shingle, and all those are one node; an empty table gives
no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import cut, slices, stored, texts_of
from .simhash import golay_tables

SHINGLE, SEED = 5, 42
#: Least similarity of linked texts, in tenths.
LEAST_TENTHS = 8
SEGMENTS, WIDTH, PROBES = 6, 23, 3
#: Of 64 signs, so many differ in a pair that is made; at a similarity of 0.8 the mean is 10 and the deviation 3.
MOST_BITS = 22
#: Of all 192 signs, so many differ in a pair that is checked on its sets; at 0.8 the mean is 29 and the deviation 5.
MOST_SIGNS = 50
#: Bins of a set's shingles whose parities are kept (a power of two), in 64-bit words.
PARITY_BINS = 1024
#: Texts of a key of which all pairs are made at once; earlier ones that a text of a larger key is paired with first; and
#: the texts that a task holds of a key.
FEW, NEAREST, BLOCK = 8, 3, 4096
#: Of the earlier ones from all places of a text, so many are checked first; the rest if they are not in its group then.
FIRST = 8
#: To move a row with its parities to where it is compared takes about as long as so many comparisons of bits.
MOVED = 256


def shingles_of(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # only A-Z change; six characters part words
    if not words:
        return np.empty(0, "<u8")
    width = min(SHINGLE, len(words))
    shingles = map(b" ".join, zip(*[itertools.islice(words, i, None) for i in range(width)]))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in shingles), dtype="<u8"))


def sums_of(hashes: np.ndarray) -> np.ndarray:
    """The signed sum of each of the segments' bits over all shingles."""
    total = np.zeros(192, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part, words = hashes[start:start + 65536], []
        for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
            x = part + np.uint64(salt)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            words.append(x ^ x >> np.uint64(31))
        bits = np.unpackbits(np.stack(words, axis=1).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        total += 2 * bits.sum(0, dtype=np.int64) - len(part)
    return total


def parities_of(hashes: np.ndarray) -> np.ndarray:
    """Whether each bin holds an odd number of the hashes, as 64-bit words."""
    bins = np.bincount((hashes & np.uint64(PARITY_BINS - 1)).astype(np.int64), minlength=PARITY_BINS)
    return np.packbits((bins & 1).astype(np.uint8), bitorder="little").view("<i8")


def may_be_similar(bins_apart, sizes):
    """Whether sets of ``sizes`` shingles together that differ in so many parities can have the similarity.

    Each shingle that one of them lacks changes one bin, so there are ``bins_apart`` such shingles or more; at a similarity
    of t there are ``sizes * (1 - t) / (1 + t)`` or fewer.  For numpy and for columns.
    """
    return (10 + LEAST_TENTHS) * bins_apart <= (10 - LEAST_TENTHS) * sizes


@functools.lru_cache(maxsize=1)
def codewords() -> np.ndarray:
    """The 4,096 codewords as columns of signs."""
    rest, _ = golay_tables()
    words = np.arange(1 << 12) << 11 | rest
    return (2 * (words[None, :] >> np.arange(WIDTH)[:, None] & 1) - 1).astype(np.float32)


def codes_of(sums: np.ndarray) -> np.ndarray:
    """The nearest codewords of every segment of each row of sums: rows x segments x probes."""
    near = []
    for s in range(SEGMENTS):
        fit, found = sums[:, s * WIDTH:(s + 1) * WIDTH].astype(np.float32) @ codewords(), []
        for _ in range(PROBES):
            best = fit.argmax(1)
            fit[np.arange(len(fit)), best] = -np.inf
            found.append(best)
        near.append(np.stack(found, axis=1))
    return np.stack(near, axis=1).astype("<u2")


def keys_of(codes: np.ndarray) -> np.ndarray:
    """The keys of each row of codes: a codeword of one segment and one of another."""
    near = codes.astype(np.int32)
    keys = [(np.int32(kind << 24) | near[:, x, :, None] << 12 | near[:, y, None, :]).reshape(len(codes), -1)
            for kind, (x, y) in enumerate(itertools.combinations(range(SEGMENTS), 2))]
    return np.concatenate(keys, axis=1)


def close_pairs(batches: Iterator[pa.RecordBatch], nearest: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, fp, node)`` sorted by key and node to pairs ``(a, b, null, null)`` of nodes, the lesser one first.

    A key with more than FEW rows gives its rows as ``(node, null, key, null)`` for :func:`meetings` and, where ``nearest`` are
    asked for, the pairs of each row with the nearest earlier ones that are held, with the bits ``apart`` in the last column.
    """
    names = ["a", "b", "key", "apart"]

    def pairs(a, b, apart=None):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.nulls(len(a), pa.int32()),
                                           pa.nulls(len(a), pa.int32()) if apart is None else pa.array(apart)], names)

    def rows(keys, nodes):
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.nulls(len(nodes), pa.int64()), pa.array(keys),
                                           pa.nulls(len(nodes), pa.int32())], names)

    def groups(keys, fps, nodes, done):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        large = sizes > FEW
        if done:
            large[0] = True  # the earlier rows of this key are passed on already
        few = np.repeat((sizes > 1) & ~large, sizes)
        k, f, n = keys[few], fps[few], nodes[few]
        for shift in range(1, FEW):  # all pairs of the small groups, at once
            if len(k) <= shift:
                break
            hit = (k[shift:] == k[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= MOST_BITS)
            if hit.any():
                yield pairs(n[shift:][hit], n[:-shift][hit])
        for start, size in zip(starts[large], sizes[large]):
            f, n = fps[start:start + size], nodes[start:start + size]
            fresh = done if start == 0 else 0
            yield rows(keys[start + fresh:start + size], n[fresh:])
            for first in range(fresh, size if nearest else 0, 256):
                last = min(first + 256, size)
                apart = np.bitwise_count(f[first:last, None] ^ f[None, :last]).astype(np.int32)
                at = np.arange(last, dtype=np.int32)
                apart[at[None, :] >= at[first:, None]] = 64
                order = apart << 16 | at  # of equally near ones the first
                close = np.partition(order, NEAREST - 1, axis=1)[:, :NEAREST] if last > NEAREST else order
                own, columns = np.nonzero(close >> 16 <= MOST_BITS)
                if len(own):
                    found = close[own, columns]
                    yield pairs(n[first:last][own], n[found & 0xFFFF], found >> 16)

    keys, fps, nodes, done = np.empty(0, np.int32), np.empty(0, np.uint64), np.empty(0, np.int64), 0
    for batch in batches:
        for part in slices([batch], BLOCK):
            keys, fps, nodes = (np.concatenate([old, part.column(c).to_numpy().view(old.dtype)])
                                for old, c in ((keys, "key"), (fps, "fp"), (nodes, "node")))
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from groups(keys[:last], fps[:last], nodes[:last], done)
                keys, fps, nodes, done = keys[last:], fps[last:], nodes[last:], 0
            if len(keys) > 2 * BLOCK:  # one key: compare what is new, and hold the latest rows
                yield from groups(keys, fps, nodes, done)
                keys, fps, nodes, done = keys[-BLOCK:], fps[-BLOCK:], nodes[-BLOCK:], BLOCK
    if len(keys):
        yield from groups(keys, fps, nodes, done)


def cell_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(key, low, high, own, node, root, fp)`` sorted by their cell (key, low, high) to all close pairs of nodes with
    different roots: of one block if low is high, else of the one with the other.

    Of rows that have ``size`` and ``parity`` too, only those pairs whose sets can be similar.
    """
    names = ["key", "low", "high", "own", "node", "root", "fp"]

    def columns(batch):
        found = [batch.column(c).to_numpy() for c in names]
        if "parity" in batch.schema.names:
            words = batch.column("parity").flatten().to_numpy().view(np.uint64)  # of signed numbers numpy counts the bits of the absolute value
            words = words.reshape(batch.num_rows, -1)
            found += [batch.column("size").to_numpy(), words]
        return found

    def possible(a, b, sizes, words):
        for first in range(0, len(a), 16384):
            x, y = a[first:first + 16384], b[first:first + 16384]
            passed = may_be_similar(np.bitwise_count(words[x] ^ words[y]).sum(1, dtype=np.int64), sizes[x] + sizes[y])
            yield x[passed], y[passed]

    def cells(held):
        key, low, high, own, node, root, fp, *sets = held
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        for start, stop in zip(starts, np.append(starts[1:], len(key))):
            n, r, f, o = node[start:stop], root[start:stop], fp[start:stop].view(np.uint64), own[start:stop]
            left = np.flatnonzero(o == low[start])
            right = left if low[start] == high[start] else np.flatnonzero(o == high[start])
            for first in range(0, len(left), 256):
                some = left[first:first + 256]
                near = (np.bitwise_count(f[some, None] ^ f[None, right]) <= MOST_BITS) & (r[some, None] != r[None, right])
                if low[start] == high[start]:
                    near &= n[some, None] < n[None, right]
                x, y = np.nonzero(near)
                x, y = some[x], right[y]
                for x, y in possible(x, y, *[c[start:stop] for c in sets]) if sets else [(x, y)]:
                    if not len(x):
                        continue
                    a, b = n[x], n[y]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    held = None
    for batch in batches:
        new = columns(batch)
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        same = np.logical_and.reduce([c == c[-1] for c in held[:3]]) if len(held[0]) else np.empty(0, bool)
        last = len(same) - int(same.sum())
        if last:
            yield from cells([c[:last] for c in held])
            held = [c[last:] for c in held]
    if held is not None and len(held[0]):
        yield from cells(held)


def hashed_nodes(docs: DataFrame, columns: tuple[str, ...], text: str) -> DataFrame:
    """``columns`` of each document, the 128-bit hash ``n1, n2`` of its shingle set, its signs, parities and codewords."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles_of(x) for x in texts_of(batch, "hashed_text")]
            names = np.array([divmod(xxhash.xxh3_128_intdigest(s.tobytes(), SEED), 1 << 64) for s in sets], dtype="<u8").view(np.int64)
            sums = np.stack([sums_of(s) for s in sets])
            signs = np.packbits(sums > 0, axis=1, bitorder="little").view("<i8")
            codes = [c.tobytes() for c in codes_of(sums)]
            words = np.stack([parities_of(s) for s in sets])
            parity = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * words.shape[1], words.ravel())
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(names[:, i].copy()) for i in range(2)] + [pa.array(signs[:, i].copy()) for i in range(3)]
                + [pa.array([len(s) for s in sets], pa.int64()), parity, pa.array(codes, pa.binary())],
                list(columns) + ["n1", "n2", "s1", "s2", "s3", "size", "parity", "codes"])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
                       + ["n1 long, n2 long, s1 long, s2 long, s3 long, size long, parity array<long>, codes binary"])
    return docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("string").alias("hashed_text")
                       ).mapInArrow(hashed, schema)


def keyed_nodes(nodes: DataFrame) -> DataFrame:
    """``(key, fp, node)`` for every key of the nodes."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<u2").reshape(batch.num_rows, SEGMENTS, PROBES)
            keys = keys_of(codes)
            each = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("s1").to_numpy(), each)),
                                              pa.array(np.repeat(batch.column("node").to_numpy(), each))], ["key", "fp", "node"])

    return nodes.select("node", "s1", "codes").mapInArrow(keyed, "key int, fp long, node long")


def first_pairs(met: DataFrame) -> DataFrame:
    """Of the pairs of :func:`close_pairs` those that are checked first: all of small keys, and of larger ones the nearest
    FIRST of each text (ties: the lesser nodes)."""
    found = met.where("b IS NOT NULL").select("a", "b", "apart")
    order = Window.partitionBy("b").orderBy("apart", "a")
    near = (found.where("apart IS NOT NULL").repartition("b").distinct()
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= FIRST))
    return found.where("apart IS NULL").select("a", "b").unionByName(near.select("a", "b")).distinct()


def meetings(large: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Rows ``(key, node)`` of large keys, and the ``(node, root)`` of groups, to ``(key, node, root, n)``: nodes that share a key
    and have different roots share one here too, of ``n`` nodes.  Without groups each node is its own root.

    Keys whose nodes have one root are left out.  The others become one key, a negative number, with the largest key that any of
    their nodes has, unless all those nodes are so many that to move them once and compare them is more work than key by key.
    """
    key, node = Window.partitionBy("key"), Window.partitionBy("node")
    grouped = large.withColumn("root", F.col("node")) if roots is None else large.join(roots, "node", "left")
    several = (grouped.select("key", "node", F.coalesce("root", "node").alias("root"))
               .withColumns({"n": F.count(F.lit(1)).over(key), "least": F.min("root").over(key), "most": F.max("root").over(key)})
               .where("least <> most").withColumn("largest", F.max(F.struct("n", "key")).over(node)))
    several = cut(several.select("key", "node", "root", "n", F.max("largest").over(key)["key"].alias("home")))
    # The work key by key in comparisons; doubles, as those of very large groups are beyond whole numbers.
    together = several.groupBy("home", "node", "root").agg(F.sum(F.col("n").cast("double") + MOVED).alias("work"))
    sizes = together.groupBy("home").agg(F.count(F.lit(1)).alias("nodes"), F.sum("work").alias("work"))
    merged = F.col("nodes") * (F.col("nodes").cast("double") + MOVED) <= F.col("work")
    return (together.drop("work").join(sizes.where(merged).select("home", "nodes"), "home")
            .select((-1 - F.col("home").cast("long")).alias("key"), "node", "root", F.col("nodes").alias("n"))
            .unionByName(several.join(sizes.where(~merged).select("home"), "home")
                         .select(F.col("key").cast("long").alias("key"), "node", "root", "n")))


def by_signs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose signs, set sizes and parities allow the similarity."""
    def side(node: str, mark: str) -> DataFrame:
        return nodes.select(F.col("node").alias(node), *[F.col(c).alias(f"{c}{mark}") for c in ("s1", "s2", "s3", "size", "parity")])

    apart = sum((F.bit_count(F.col(f"s{i}a").bitwiseXOR(F.col(f"s{i}b"))) for i in range(1, 4)), F.lit(0))
    sizes = 10 * F.least("sizea", "sizeb") >= LEAST_TENTHS * F.greatest("sizea", "sizeb")
    bins = F.aggregate(F.zip_with("paritya", "parityb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    possible = may_be_similar(bins, F.col("sizea") + F.col("sizeb"))
    return (pairs.join(side("a", "a"), "a").join(side("b", "b"), "b")
            .where(sizes & (apart <= MOST_SIGNS) & possible).select("a", "b"))


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets ``(node, hashes)`` are similar enough."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            passed = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                shared = len(np.intersect1d(x, y, assume_unique=True))
                passed.append(10 * shared >= LEAST_TENTHS * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(checked, "a long, b long"))


def near_copies(docs: DataFrame, row: tuple[str, ...], text: str = "text") -> DataFrame:
    """``row`` (columns that tell the documents apart) of each document and its ``component`` (a node of it)."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles_of(x).tobytes() for x in texts_of(batch, "hashed_text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])

    known = stored(hashed_nodes(docs, row, text), "shingles")
    # Of documents with equal sets any may stand for the node.
    first = F.min(F.struct(*row)).alias("first_")
    nodes = known.groupBy("n1", "n2").agg(first, *[F.first(c).alias(c) for c in ("s1", "s2", "s3", "size", "parity", "codes")])
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs that are similar."""
        near = cut(by_signs(pairs, nodes))
        asked = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        texts = docs.select(*row, F.col(f"`{text}`").cast("string").alias("hashed_text")).join(
            nodes.join(asked, "node").select("node", "first_.*"), list(row))
        sets = stored(texts.dropDuplicates(["node"]).select("node", "hashed_text").mapInArrow(hashed, "node long, hashes binary"), name)
        return cut(similar(near, sets))

    def by_key(rows: DataFrame, nearest: bool) -> DataFrame:
        """The rows of :func:`close_pairs`."""
        def met_by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return close_pairs(batches, nearest)

        return stored(rows.repartition("key").sortWithinPartitions("key", "node")
                      .mapInArrow(met_by_key, "a long, b long, key int, apart int"), "met")

    def large_of(met: DataFrame) -> DataFrame:
        return met.where("b IS NULL").select("key", F.col("a").alias("node"))

    met = by_key(keyed_nodes(nodes.where("size > 0")), nearest=False)
    large = large_of(met)
    if not large.isEmpty():
        # From here on the keys are those that were put together (odd numbers) or stay as they are (even ones).
        again = F.when(F.col("key") < 0, -2 * F.col("key") - 1).otherwise(2 * F.col("key")).cast("int").alias("key")
        homes = by_key(meetings(large).select(again, "node").join(nodes.select("node", F.col("s1").alias("fp")), "node")
                       .select("key", "fp", "node"), nearest=True)
        met, large = met.where("b IS NOT NULL").unionByName(homes), large_of(homes)
    pairs = stored(first_pairs(met), "pairs")
    links = linked(pairs, "shingle-sets")
    if not large.isEmpty():
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        cells = (meetings(large, connected_components(links)).withColumn("blocks", blocks).withColumn("own", own)
                 .join(nodes.select("node", F.col("s1").alias("fp"), "size", "parity"), "node")
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root", "fp",
                         "size", "parity"))
        more = (cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(cell_pairs, "a long, b long")
                .distinct().join(pairs, ["a", "b"], "left_anti"))
        links = links.unionByName(linked(more, "shingle-sets"))
    roots = connected_components(links)
    lookup = nodes.join(roots, "node", "left").select("n1", "n2", F.coalesce("root", "node").alias("component"))
    return known.select(*row, "n1", "n2").join(lookup, ["n1", "n2"]).select(*row, "component")
