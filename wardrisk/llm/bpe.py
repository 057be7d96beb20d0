"""Byte-level BPE encoding and decoding with a lexicon of the corpus's frequent words.

Word counts over all documents choose the frequent words (at most ``LEXICON_WORDS``); their ids are
merged once on the driver and compiled into a minimal acyclic transducer, which Spark sends to every
executor as a file and workers map into memory.  Words it lacks are merged exactly, by the merge
list.  The lexicon changes the time, never the ids.

Defined results: a null or empty text has no ids and decodes to an empty text; strings of special
tokens get their ids; repeated rows give repeated results; an empty table gives no rows; columns
other than those asked for are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import tempfile
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lexicon import LONGEST, Lexicon, compile_lexicon
from .shared import LATIN_LETTERS, LATIN_PATTERN, LATIN_TEXT, slices, stored, texts_of, vocabulary_file

VOCABULARY = "byte_bpe_50k.json"
LEXICON_WORDS = 60_000
#: Words whose ids a worker remembers besides the lexicon.
REMEMBERED = 400_000
#: Bits of an id in a pair or a merge; no merge is larger than NONE.
ID_BITS = 20
ID_MASK, NONE = (1 << ID_BITS) - 1, 1 << 62


@functools.lru_cache(maxsize=1)
def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, to that byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges and tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            content = json.load(source)
        self.path, model, to_byte = path, content["model"], byte_characters()
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # One number for a pair and one for its merge, the rank above the new id: the least is merged first.
        self.merges = {ids[a] << ID_BITS | ids[b]: rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        self.of_byte = [0] * 256
        for character, byte in to_byte.items():
            self.of_byte[byte] = ids[character]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes, self.text = [b""] * size, [str(i) for i in range(size)]
        for token, i in ids.items():
            self.bytes[i] = bytes(to_byte[c] for c in token if c in to_byte)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    @functools.cached_property
    def splitter(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).pre_tokenizer

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: always the earliest merge of the list, the leftmost of equals."""
        ids = [self.of_byte[b] for b in word]
        if len(ids) > 100:
            return self.merge_long(ids)
        merge = self.merges.get
        merges = [merge(a << ID_BITS | b, NONE) for a, b in zip(ids, ids[1:])]
        while merges and (best := min(merges)) != NONE:
            i = merges.index(best)
            ids[i] = best & ID_MASK
            del ids[i + 1], merges[i]
            if i:
                merges[i - 1] = merge(ids[i - 1] << ID_BITS | ids[i], NONE)
            if i < len(merges):
                merges[i] = merge(ids[i] << ID_BITS | ids[i + 1], NONE)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same in time n log n, over a linked list with a heap of possible merges."""
        ids, n = list(ids), len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = [a << ID_BITS | b for a, b in zip(ids, ids[1:])]
        heap = [(self.merges[pair], i, pair) for i, pair in enumerate(pairs) if pair in self.merges]
        heapq.heapify(heap)
        while heap:
            merge, left, pair = heapq.heappop(heap)
            right = after[left]
            if right >= n or ids[left] < 0 or ids[right] < 0 or ids[left] << ID_BITS | ids[right] != pair:
                continue
            ids[left], ids[right] = merge & ID_MASK, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for start in (before[left], left):
                if start >= 0 and after[start] < n:
                    pair = ids[start] << ID_BITS | ids[after[start]]
                    if pair in self.merges:
                        heapq.heappush(heap, (self.merges[pair], start, pair))
        return [i for i in ids if i >= 0]

    def pieces(self, text: str) -> list[str]:
        if LATIN_TEXT.fullmatch(text):
            return LATIN_PATTERN.findall(text)
        to_byte = byte_characters()
        return [bytes(to_byte[c] for c in piece).decode() for piece, _ in self.splitter.pre_tokenize_str(text)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Texts to ids: the lexicon first, then what was merged before, then exact merging."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None = None):
        self.vocab, self.lexicon, self.known = vocab, lexicon, {}

    def learn(self, words: list[str]) -> None:
        encoded = [w.encode() for w in words]
        found = self.lexicon.find(encoded) if self.lexicon else [None] * len(words)
        for word, data, ids in zip(words, encoded, found):
            self.known[word] = ids if ids is not None else array("I", self.vocab.merge(data)).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = []
        for text in texts:
            parts = []
            if any(s in text for s in self.vocab.special):
                at = 0
                for match in self.vocab.special_pattern.finditer(text):
                    parts += [self.vocab.pieces(text[at:match.start()]), self.vocab.special[match.group()]]
                    at = match.end()
                parts.append(self.vocab.pieces(text[at:]))
            else:
                parts.append(self.vocab.pieces(text))
            split.append(parts)
        words = {w for parts in split for part in parts if isinstance(part, list) for w in part}
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.learn(sorted(words.difference(self.known)))
        of_word = self.known.__getitem__
        return [np.frombuffer(b"".join(
            b"".join(map(of_word, part)) if isinstance(part, list) else np.array([part], "<u4").tobytes()
            for part in parts), dtype="<u4") for parts in split]


_ENCODERS: dict[tuple, Encoder] = {}


def worker_encoder(name: str, lexicon_file: str) -> Encoder:
    if (name, lexicon_file) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name, lexicon_file] = Encoder(vocabulary(vocabulary_file(name)), Lexicon(SparkFiles.get(lexicon_file)))
    return _ENCODERS[name, lexicon_file]


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The words of the corpus with the highest counts, ``most`` at most: those above a common count.

    Counts are grouped by eighths of a power of two, so the bound is found from a few hundred rows.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"),
                                                       F.lit(f" ?[{LATIN_LETTERS}]+"), F.lit(0))).alias("word"))
    level = F.floor(F.log2(F.col("n")) * 8).cast("int")
    counts = stored(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .where(F.octet_length("word") <= LONGEST).withColumn("level", level), "words")
    total, bound = 0, None
    for row in counts.groupBy("level").count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > most:
            break
        bound = row["level"]
    return [] if bound is None else [r["word"] for r in counts.where(F.col("level") >= bound).select("word").collect()]


def build_lexicon(docs: DataFrame, name: str = VOCABULARY, text: str = "text", most: int = LEXICON_WORDS) -> str:
    """Compile the frequent words and hand the file to all executors; returns the file's name there."""
    vocab = vocabulary(vocabulary_file(name))
    entries = [(word.encode(), vocab.merge(word.encode())) for word in frequent_words(docs, text, most)]
    folder = tempfile.mkdtemp(prefix="lexicon-")
    draft = os.path.join(folder, "draft")
    compile_lexicon(entries, draft)
    with open(draft, "rb") as content:
        file = f"lexicon-{hashlib.sha256(content.read()).hexdigest()[:24]}.bin"
    os.rename(draft, os.path.join(folder, file))
    if not any(f.endswith(file) for f in docs.sparkSession.sparkContext.listFiles):
        docs.sparkSession.sparkContext.addFile(os.path.join(folder, file))
    return file


def encode_and_decode(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text",
                      name: str = VOCABULARY, most: int = LEXICON_WORDS) -> DataFrame:
    """``columns`` of each document with its ``ids`` and the text ``decoded`` from them."""
    file = build_lexicon(docs, name, text, most)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(name, file)
        for batch in slices(batches):
            ids = encoder.encode(texts_of(batch, "coded_text"))
            offsets = np.cumsum([0] + [len(i) for i in ids])
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                              pa.array(np.concatenate(ids).astype(np.int32), pa.int32()))
            decoded = pa.array([encoder.vocab.decode(i.tolist()) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [arrays, decoded], list(columns) + ["ids", "decoded"])

    return with_text(docs, columns, text).mapInArrow(coded, kinds(docs, columns) + ", ids array<int>, decoded string")


def digests(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), text: str = "text",
            name: str = VOCABULARY, most: int = LEXICON_WORDS) -> DataFrame:
    """Like encode_and_decode(), but with n_tokens, ids_sha256 and decoded_sha256 in place of ids and text."""
    file = build_lexicon(docs, name, text, most)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(name, file)
        vocab = encoder.vocab
        for batch in slices(batches):
            rows = []
            for ids in map(np.ndarray.tolist, encoder.encode(texts_of(batch, "coded_text"))):
                rows.append((len(ids), hashlib.sha256(",".join(map(vocab.text.__getitem__, ids)).encode()).hexdigest(),
                             hashlib.sha256(vocab.decode(ids).encode()).hexdigest()))
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + arrays,
                                             list(columns) + ["n_tokens", "ids_sha256", "decoded_sha256"])

    return with_text(docs, columns, text).mapInArrow(
        digested, kinds(docs, columns) + ", n_tokens long, ids_sha256 string, decoded_sha256 string")


def with_text(docs: DataFrame, columns: tuple[str, ...], text: str) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("string").alias("coded_text"))


def kinds(docs: DataFrame, columns: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
