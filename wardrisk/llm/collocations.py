"""Phrase collocations: every frequent n-gram by mergeable Misra-Gries summaries, then counted exactly and scored.

Texts are split into pieces and words once, and stored as hashes of words (the language is part of the hash).  For each
length in turn, tasks count the n-grams of their texts by hash and deal the counts out by the leading bits of the hash.
Each such hash partition merges them into one Misra-Gries summary: when there are more counters than its capacity, the
count of the first one beyond it is taken from all, and what is not above zero goes.  The capacity exceeds the
partition's mass divided by the threshold.  As each unit taken costs more than capacity units of mass, less than the
threshold is taken in all, so every n-gram that is frequent enough survives.  The mass is known before the first
counter: tasks send their masses along, sorted before the counts.  An n-gram is looked at only where both its parts
without the last and the first word survived (a bit set of the survivors' hashes, ``MOST_BITS`` at most: beyond, more
n-grams pass than need to, and none is lost).

A second pass reads the texts again and counts the survivors exactly, by their words.  Only counts of texts' own words
reach the result; hashes decide nothing in it.

Defined results: a null text is empty, a null language is ``und``; languages without any phrase give no rows; repeated
rows count each; an empty table gives no rows; a word of any length is a word; columns but the text and its language
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import slices, stored, texts_of

LONGEST, THRESHOLD, TOP = 5, 100, 2000
#: N-grams that a task counts at a time, and those of one hash partition (its summary has at most a hundredth of them as counters).
CHUNK, PARTITION_MASS = 1 << 20, 1 << 24
#: Bits of a set of survivors: at least, at most (16 MB), and for each survivor.
LEAST_BITS, MOST_BITS, BITS_A_GRAM = 20, 27, 32
#: A text's separators become line feeds, its tabs spaces (fixed values).
TABLE = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str) -> list[bytes]:
    """The words of a text in order; a line feed stands between pieces."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(TABLE)  # only A-Z change
    return [t for t in data.replace(b"\n", b" \n ").split(b" ") if t]


def seed_of(lang: str) -> int:
    return zlib.crc32(lang.encode("utf-8", "surrogatepass"))


def hashes_of(tokens: list[bytes], seed: int) -> np.ndarray:
    """A hash of each word, never zero; zero between pieces."""
    ids = np.fromiter((xxhash.xxh3_64_intdigest(t, seed) | 1 for t in tokens), dtype=np.uint64, count=len(tokens))
    ids[np.fromiter((t == b"\n" for t in tokens), dtype=bool, count=len(tokens))] = 0
    return ids


def longer(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams and of the words after them to hashes of the longer n-grams."""
    x = (grams ^ grams >> np.uint64(29)) * MULTIPLIER + words
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Bits:
    """A set of 64-bit hashes by their leading bits; others may seem to be in it."""

    def __init__(self, data: np.ndarray):
        self.data, self.shift = data, np.uint64(64 - (len(data) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def runs_of(words: np.ndarray, length: int, sets: list[Bits]) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the n-grams of a length, within pieces, both of whose shorter parts are in the last set."""
    at = np.flatnonzero(words)
    grams = words[at]
    for n in range(2, length + 1):
        known = sets[n - 2].has(grams)
        at, grams = at[known], grams[known]
        if len(at) < 2:
            return at[:0], grams[:0]
        # The part from the next place on is the next one that is left, if its place follows.
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, last = at[both], words[at[both] + n - 1] if len(both) else words[:0]
        grams = longer(grams[both], last)
    return at, grams


def word_hashes(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The hashed words of each text, a zero between pieces."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out, counts = [], []
            for content, name in zip(texts_of(batch, "mined_text"), batch.column("lang").to_pylist()):
                ids = hashes_of(tokens_of(content), seed_of(name))
                out.append(ids.tobytes())
                counts.append(int(np.count_nonzero(ids)))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(counts, pa.int64()), pa.array(out, pa.binary())],
                                             ["lang", "n", "words"])

    return mined(docs, text, lang).mapInArrow(hashed, "lang string, n long, words binary")


def mined(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("mined_text"))


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The stored words of many texts as arrays of about ``size``, a zero after each text."""
    parts, n = [], 0
    for batch in slices(batches):
        for words in batch.column("words"):
            array = np.frombuffer(words.as_buffer(), dtype=np.uint64)
            parts += [array, np.zeros(1, np.uint64)]
            n += len(array) + 1
            if n >= size:
                yield np.concatenate(parts)
                parts, n = [], 0
    if parts:
        yield np.concatenate(parts)


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts."""
    if counts is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary with a fixed number of counters, into which counts are merged."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = counted(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        if len(self.hashes) > self.capacity:
            beyond = len(self.counts) - self.capacity - 1
            least = np.partition(self.counts, beyond)[beyond]  # the largest but ``capacity``
            left = self.counts > least
            self.hashes, self.counts = self.hashes[left], self.counts[left] - least
            self.taken += int(least)

    def frequent(self, threshold: int) -> np.ndarray:
        """The hashes whose count may be the threshold or more: what was taken is added."""
        return self.hashes[self.counts + self.taken >= threshold]


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    for kind in (np.uint8, np.uint16, np.uint32):
        if not len(values) or values.max() <= np.iinfo(kind).max:
            return values.astype(kind).tobytes()
    return values.astype(np.uint64).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // n}").astype(np.uint64)


#: A summary of one task's chunk for one hash partition: its mass alone (kind 0), or its counters: the differences of the
#: sorted hashes, whose lower 16 bits stand apart as they are as good as random, and the counts.
SUMMARIES = "part int, kind tinyint, n long, low binary, high binary, counts binary"


def survivors(texts: DataFrame, length: int, sets, threshold: int, splits: int, width: int) -> DataFrame:
    """Per hash partition ``part`` the leading ``width`` bits of the hashes that its summary still has, as binaries of at
    most CHUNK numbers; hashes that share these bits are one counter, which only lets more pass."""
    cut, shift = np.uint64(64 - width), np.uint64(width - splits)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sets.value
        for words in gathered(batches, CHUNK):
            grams, counts = counted(runs_of(words, length, known)[1] >> cut)
            parts = (grams >> shift).astype(np.int64)
            rows: list[tuple] = []
            bounds = np.searchsorted(parts, np.arange((1 << splits) + 1))
            for part in np.unique(parts).tolist():
                own, n = grams[bounds[part]:bounds[part + 1]], counts[bounds[part]:bounds[part + 1]]
                steps = np.diff(own, prepend=np.uint64(part) << shift)
                rows.append((part, 0, int(n.sum()), b"", b"", b""))
                rows.append((part, 1, len(own), (steps & np.uint64(0xFFFF)).astype(np.uint16).tobytes(),
                             packed(steps >> np.uint64(16)), packed(n)))
            kinds = (pa.int32(), pa.int8(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                             [f.split()[0] for f in SUMMARIES.split(", ")])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary, waiting, held = None, 0, None, [], 0

        def flush():
            nonlocal waiting, held
            if waiting:
                summary.merge(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))
            waiting, held = [], 0

        def left():
            flush()
            hashes = summary.frequent(threshold)
            for start in range(0, len(hashes), CHUNK):
                own = hashes[start:start + CHUNK]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(own)], pa.int64()),
                                                  pa.array([own.tobytes()], pa.binary())], ["part", "n", "grams"])

        for batch in slices(batches, 64):
            for own, kind, n, low, high, counts in zip(*[c.to_pylist() for c in batch.columns]):
                if own != part:
                    if summary is not None:
                        yield from left()
                    part, mass, summary = own, 0, None
                if kind == 0:
                    mass += n
                    continue
                if summary is None:  # all masses have come
                    summary = Summary(mass // threshold + 1)
                steps = unpacked(high, n) << np.uint64(16) | unpacked(low, n)
                waiting.append(((np.uint64(own) << shift) + np.cumsum(steps), unpacked(counts, n).astype(np.int64)))
                held += n
                if held >= max(CHUNK // 4, summary.capacity):
                    flush()
        if summary is not None:
            yield from left()

    return (texts.select("words").mapInArrow(dealt, SUMMARIES).repartition("part").sortWithinPartitions("part", "kind")
            .mapInArrow(merged, "part int, n long, grams binary"))


def bits_of(found: DataFrame, splits: int, given: int) -> np.ndarray:
    """The bit set of the survivors (hashes of ``given`` bits); each row of ``found`` fills bits of its own partition's stretch,
    at most MOST_BITS come here."""
    n = found.agg(F.sum("n")).first()[0] or 0
    width = max(LEAST_BITS, splits + 3)
    while width < MOST_BITS and 1 << width < n * BITS_A_GRAM:
        width += 1
    shift, stretch = np.uint64(given - width), 1 << (width - splits - 3)

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            bits = np.zeros(stretch * 8, dtype=bool)
            grams = np.frombuffer(batch.column("grams")[0].as_buffer(), dtype=np.uint64)
            bits[(grams >> shift).astype(np.int64) & (stretch * 8 - 1)] = True
            packed = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array([packed], pa.binary())], ["part", "bits"])

    data = np.zeros(1 << (width - 3), dtype=np.uint8)
    for row in found.mapInArrow(filled, "part int, bits binary").toLocalIterator():
        data[row["part"] * stretch:(row["part"] + 1) * stretch] |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return data


def exact_counts(docs: DataFrame, text: str, lang: str, sets, threshold: int, splits: int) -> DataFrame:
    """``(lang, words, phrase, f)`` of the n-grams with at least ``threshold`` places, counted by their words.

    A task's counts go to the n-grams' hash partitions in rows of many phrases, and are added up there.
    """
    shift = np.uint64(64 - splits)

    names = ["part", "lang", "words", "phrase"]

    def total(tables: list[pa.Table], keys: list[str]) -> pa.Table:
        return pa.concat_tables(tables).group_by(keys).aggregate([("f", "sum")]).rename_columns([*keys, "f"])

    def local(lang_name: str, tokens: list[bytes], known: list[Bits]) -> Iterator[pa.Table]:
        number: dict[bytes, int] = {b"\n": 0}
        ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), dtype=np.int64, count=len(tokens))
        hashes = hashes_of(list(number), seed_of(lang_name))[ids]
        at = np.flatnonzero(ids)
        grams, same = hashes[at], ids[at]  # ``same`` is equal just where all the words are
        for n in range(1, len(known) + 1):
            left = known[n - 1].has(grams)
            at, grams, same = at[left], grams[left], same[left]
            if not len(at):
                return
            _, first, same, counts = np.unique(same, return_index=True, return_inverse=True, return_counts=True)
            phrases = pa.array([b" ".join(tokens[i:i + n]) for i in at[first].tolist()], pa.binary()).cast(pa.string())
            yield pa.table([pa.array((grams[first] >> shift).astype(np.int32)), pa.repeat(lang_name, len(first)),
                            pa.array(np.full(len(first), n, np.int32)), phrases, pa.array(counts.astype(np.int64))], [*names, "f"])
            both = np.flatnonzero(at[1:] == at[:-1] + 1)
            same = same.astype(np.int64)[both] << 32 | ids[at[both] + n]
            grams, at = longer(grams[both], hashes[at[both] + n]), at[both]

    def by_part(tables: list[pa.Table]) -> pa.RecordBatch:
        """One row per partition with the lists of its phrases and counts."""
        rows = total(tables, names).sort_by("part").combine_chunks()
        parts = rows["part"].to_numpy()
        own = np.unique(parts)
        offsets = pa.array(np.append(np.searchsorted(parts, own), len(parts)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, rows[c].combine_chunks()) for c in (*names[1:], "f")]
        return pa.RecordBatch.from_arrays([pa.array(own), *lists], [*names, "f"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, waiting, held, tables = sets.value, {}, 0, []

        def count() -> None:
            nonlocal waiting, held, tables
            new = [t for name, tokens in waiting.items() for t in local(name, tokens, known)]
            if new:
                tables = [total(tables + new, names)]
            waiting, held = {}, 0

        for batch in slices(batches):
            for content, name in zip(texts_of(batch, "mined_text"), batch.column("lang").to_pylist()):
                tokens = tokens_of(content)
                waiting.setdefault(name, []).extend(tokens)
                waiting[name].append(b"\n")
                held += len(tokens) + 1
                if held >= CHUNK:
                    count()
                    if tables and tables[0].num_rows >= CHUNK:
                        yield by_part(tables)
                        tables = []
        count()
        if tables:
            yield by_part(tables)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tables, held = None, [], 0

        def left() -> Iterator[pa.RecordBatch]:
            found = total(tables, names[1:])
            yield from found.filter(pc.greater_equal(found["f"], threshold)).to_batches()

        for batch in slices(batches, 1):
            own = batch.column("part")[0].as_py()
            if own != part:
                if tables:
                    yield from left()
                part, tables, held = own, [], 0
            tables.append(pa.table([batch.column(c).flatten() for c in (*names[1:], "f")], [*names[1:], "f"]))
            held += tables[-1].num_rows
            if held >= CHUNK:
                tables = [total(tables, names[1:])]
                held = tables[0].num_rows // 2
        if tables:
            yield from left()

    return (mined(docs, text, lang).mapInArrow(places, "part int, lang array<string>, words array<int>, phrase array<string>, f array<long>")
            .repartition("part").sortWithinPartitions("part").mapInArrow(added, "lang string, words int, phrase string, f long"))


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                     threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """The stored frequent n-grams ``(lang, words, phrase, f)``, single words included, and ``(lang, n)``: all words."""
    context = docs.sparkSession.sparkContext
    texts = stored(word_hashes(docs, text, lang), "words")
    totals = texts.groupBy("lang").agg(F.sum("n").alias("n"))
    mass = totals.agg(F.sum("n")).first()[0] or 0
    splits = 0
    while PARTITION_MASS << splits < mass:
        splits += 1
    splits = max(splits, 6)
    width = min(64, max(40, mass.bit_length() + 8))  # so that few n-grams share their bits
    sets: list[Bits] = []
    for length in range(1, longest + 1):
        found = stored(survivors(texts, length, context.broadcast(sets), threshold, splits, width), "survivors")
        if found.isEmpty():
            break
        sets.append(Bits(bits_of(found, splits, width)))
    return stored(exact_counts(docs, text, lang, context.broadcast(sets), threshold, splits), "frequent"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                 threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases by the score of their lowest-scoring cut.

    The score is floor(1000 * a * n / (l * r)) in decimals of 38 digits.  Phrases inside a longer one that is as frequent
    are left out.
    """
    frequent, totals = frequent_phrases(docs, text, lang, longest, threshold)
    phrases = frequent.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts"))
    parts = frequent.select("lang", "phrase", "f")

    def run(first, size):
        return F.array_join(F.slice("parts", first, size), " ")

    cuts = phrases.select("lang", "phrase", "a", "parts", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", run(F.lit(1), F.col("k")).alias("left_"), run(F.col("k") + 1, F.size("parts")).alias("right_"))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left_"), F.col("f").alias("l")), ["lang", "left_"])
              .join(parts.select("lang", F.col("phrase").alias("right_"), F.col("f").alias("r")), ["lang", "right_"])
              .join(totals, "lang").withColumn("score", F.expr(
                  "(cast(a AS decimal(19,0)) * cast(n AS decimal(19,0)) * 1000) DIV (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where(F.size("parts") > 2).select("lang", "a", "parts", F.explode(F.sequence(F.lit(2), F.size("parts") - 1)).alias("size"))
    inner = inner.select("lang", "a", "parts", "size", F.explode(F.sequence(F.lit(1), F.size("parts") - F.col("size") + 1)).alias("first"))
    covered = (inner.select("lang", run(F.col("first"), F.col("size")).alias("phrase"), F.col("a").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(covered, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").select(
        "lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of a language are among the first of each of its shares, so no task ranks a whole language.
    share = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    share = share.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    ranked = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
