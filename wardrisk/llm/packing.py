"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

Pieces of one length are interchangeable, and so are open sequences with one remaining capacity.
So the packing is planned on the histogram of lengths alone (at most one row per length, whatever
the corpus): lengths go in decreasing order, each to the tightest open sequences, which a segment
tree over remaining capacities finds in logarithmic time.  The plan says which ranks of a length go
to which sequences; every piece then looks up its own rank.  The result is exactly best-fit
decreasing over all documents, while tokens and documents stay on the executors.

Defined results: a null or empty text is one piece, the closing id alone; repeated rows and repeated
ids are packed each; null ids stay null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import LATIN_LETTERS, LATIN_TEXT, Memo, packed_ids, slices, stored, texts_of, vocabulary_file

VOCABULARY, SIZE, CLOSING_ID = "word_bpe_49k.json", 2048, 0
#: The vocabulary's own splitting pattern for lower-case texts that LATIN_TEXT admits.
WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LATIN_LETTERS}]+|[0-9]|[^\s0-9{LATIN_LETTERS}]+")
#: Letters whose lower case is longer or outside LATIN_LETTERS, and special tokens: left to the library.
UNUSUAL = re.compile(r"[İȺȾ]|<\|(?:startoftext|endoftext)\|>")
PIECES = "piece int, start long, length long, ids_crc32 long, part int, local_rank long"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printed in Latin-1, else the
    next one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


class WordIds(Memo):
    """Ids of single words as little-endian 32-bit numbers, by the library's model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.model, self.characters = self.library.model, byte_characters()

    def compute(self, word: str) -> bytes:
        """A word that the splitting pattern has found is in lower case; one in normal form goes to the model at once."""
        if word.isascii():
            spelled = word
        elif unicodedata.is_normalized("NFC", word):
            spelled = "".join([self.characters[b] for b in word.encode()])
        else:
            return self.whole(word)
        return packed_ids([token.id for token in self.model.tokenize(spelled)])

    def whole(self, text: str) -> bytes:
        return packed_ids(self.library.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if LATIN_TEXT.fullmatch(text) and not UNUSUAL.search(text):
            return b"".join(map(self.__getitem__, WORDS.findall(text.lower())))
        return self.whole(text)


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Capacities:
    """How many sequences are open at each remaining capacity; a segment tree finds the tightest fit."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = np.zeros(2 * self.leaves, dtype=np.int64)

    def add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += n
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` with an open sequence."""
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan(histogram: Mapping[int, int], size: int = SIZE) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, first offset), sorted by length and rank."""
    tree, spans, fresh, rows = Capacities(size), defaultdict(list), 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, int(histogram[length])
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = size
                n = -(-left // (size // length))
                spans[size].append((fresh, n))
                tree.add(size, n)
                fresh += n
            each = min(capacity // length, left)  # the sequence just used is the tightest until it is full
            first, n = spans[capacity].pop()
            take = min(n, left // each)
            if take < n:
                spans[capacity].append((first + take, n - take))
            rows.append((length, rank, each, first, size - capacity))
            tree.add(capacity, -take)
            rest = capacity - each * length
            if rest:
                spans[rest].append((first, take))
                tree.add(rest, take)
            rank += take * each
            left -= take * each
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def cut_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
               size: int = SIZE, closing_id: int = CLOSING_ID) -> DataFrame:
    """The pieces of every document, numbered within their task among the pieces of the same length."""
    closing = np.array([closing_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, part = word_ids(vocabulary_file(vocabulary)), defaultdict(int), TaskContext.get().partitionId()
        for batch in slices(batches):
            rows, which = [], []
            for row, content in enumerate(texts_of(batch, "packed_text")):
                ids = known.encode(content) + closing
                for number, start in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[start:start + 4 * size]
                    length = len(own) // 4
                    rows.append((number, start // 4, length, zlib.crc32(own), part, seen[length]))
                    which.append(row)
                    seen[length] += 1
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int32()))]
                + [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)],
                ["doc_id"] + [p.split()[0] for p in PIECES.split(", ")])

    kind = docs.schema[doc_id].dataType.simpleString()
    return (docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("packed_text"))
            .mapInArrow(pieces, f"doc_id {kind}, {PIECES}"))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
         size: int = SIZE, closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece: where it starts in its document, its sequence and its place there."""
    pieces = stored(cut_pieces(docs, doc_id, text, vocabulary, size, closing_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan(histogram, size)  # at most ``size`` lengths were collected
    keys = (steps[:, 0] << 48) + steps[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            _, first, each, sequence, offset = steps[np.searchsorted(keys, (length << 48) + rank, side="right") - 1].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(sequence + nth // each), pa.array(offset + nth % each * length)],
                batch.schema.names[:-1] + ["sequence_id", "offset"])

    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local_rank")).alias("rank"))
    kind = ranked.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(placed, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
