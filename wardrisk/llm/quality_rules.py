"""Quality rules: word counts and the fertility of public vocabularies, judged in one pass per document.

Fertility is measured with two vocabularies: characters per token and the entropy of the token distribution with a
byte-level one, the byte-fallback share with a piece vocabulary: of the pieces that it encodes the text to, its
normalisation included, those that are single bytes.  A document is rejected outside the band of its script, the script
of most of its letters.

Defined results: a null or empty text has no words, so it fails the base rules, and no pieces, so its shares are zero;
repeated rows are judged each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import encode, piece_ids, slices, texts_of, vocabulary_file

TOKENS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


class Band(NamedTuple):
    """What a document of a script may measure.

    Characters per token and the byte-fallback share have fixed bounds; the least entropy in bits is
    ``base + slope * log2(tokens)``, at most ``top``, since a longer text has room for more tokens.
    """
    least_chars: float
    most_chars: float
    most_fallback: float
    base: float
    slope: float
    top: float

    def admits(self, chars_per_token: float, fallback: float, bits: float, tokens: int) -> bool:
        least_bits = min(self.top, self.base + self.slope * math.log2(max(tokens, 1)))
        return (self.least_chars <= chars_per_token <= self.most_chars and fallback <= self.most_fallback
                and bits >= least_bits)


#: Scripts by their first code point (fixed values from the Unicode blocks), each up to the next.
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"),
           (0x600, "arabic"), (0x700, "other"), (0x900, "indic"), (0xE00, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"))
#: Prose of the script stays well inside; symbols between words, capitals throughout and word loops do not.
BANDS = {"latin": Band(1.7, 9.0, 0.25, 2.9, 0.3, 6.0), "greek": Band(0.5, 9.0, 0.40, 1.5, 0.3, 4.5),
         "cyrillic": Band(0.5, 9.0, 0.40, 1.5, 0.3, 4.5), "hebrew": Band(0.4, 9.0, 0.60, 1.5, 0.3, 4.0),
         "arabic": Band(0.4, 9.0, 0.60, 1.5, 0.3, 4.0), "han": Band(0.25, 9.0, 1.0, 1.5, 0.3, 4.0),
         "kana": Band(0.25, 9.0, 1.0, 1.5, 0.3, 4.0), "hangul": Band(0.25, 9.0, 1.0, 1.5, 0.3, 4.0),
         "indic": Band(0.2, 9.0, 1.0, 1.5, 0.3, 4.0), "other": Band(0.2, 9.0, 0.85, 1.5, 0.3, 4.0),
         "none": Band(1.0, 9.0, 0.5, 1.0, 0.2, 3.0)}

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
RULES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
         "kept boolean, script string, chars_per_token double, byte_fallback double, token_entropy double")

_STARTS = [0] + [start for start, _ in SCRIPTS]
_NAMES = ["none"] + [name for _, name in SCRIPTS]


class Pieces:
    """A piece vocabulary, and which of its pieces are single bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def share(self, text: str) -> float:
        """Byte pieces among the pieces of a text."""
        ids = self.model.encode_as_numpy(text)
        return np.count_nonzero(self.is_byte[ids]) / len(ids) if len(ids) else 0.0


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def script_of(counts: Mapping[str, int]) -> str:
    """The script of most letters; ties go to the script that SCRIPTS names first."""
    found = dict.fromkeys(name for _, name in SCRIPTS)
    for character, n in counts.items():
        if character.isalpha():
            name = _NAMES[bisect.bisect_right(_STARTS, ord(character)) - 1]
            found[name] = (found.get(name) or 0) + n
    best = max(found, key=lambda name: found[name] or 0)
    return best if found[best] else "none"


def character_counts(text: str) -> dict[str, int]:
    """Like Counter(text); one scan for each character is faster if the text has few distinct ones."""
    distinct = set(text)
    return {c: text.count(c) for c in distinct} if len(distinct) <= 150 else dict(Counter(text))


def repeated_words(words: list) -> int:
    """Words inside a window of three that the text has at least twice."""
    if len(words) < 3:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
    hashes = (hashes[:-2] * 3 + hashes[1:-1]) * 5 + hashes[2:]  # equal windows have equal ones, others hardly ever
    ordered = np.sort(hashes)
    several = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(several):
        return 0
    places = np.flatnonzero(np.isin(hashes, several))
    windows = [tuple(words[i:i + 3]) for i in places.tolist()]
    counts = Counter(windows)
    places = places[np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))]
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[places + shift] = True
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the document's own token distribution."""
    if not len(ids):
        return 0.0
    ordered = np.sort(ids)
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    shares = np.diff(ends, prepend=-1) / len(ids)
    return float(-(shares * np.log2(shares)).sum()) + 0.0


def judge(text: str, memo, pieces: Pieces, bands: Mapping[str, Band]) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() parts at exactly these six characters
    n, repeats = len(words), repeated_words(words)
    counts = character_counts(text)
    word_chars = len(text) - sum(counts.get(c, 0) for c in SPACES)
    failed = n < 50 or 100 * repeats > 50 * n
    ids = encode(memo, text)
    script, tokens = script_of(counts), max(len(ids), 1)
    fertility, share, bits = len(text) / tokens, pieces.share(text), entropy(ids)
    good = (bands.get(script) or bands["other"]).admits(fertility, share, bits, len(ids))
    return (n, word_chars, sum(counts.get(c, 0) for c in SYMBOLS), repeated_lines(text), repeats, failed, good and not failed,
            script, fertility, share, bits)


def apply_rules(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), bands: Mapping[str, Band] = BANDS,
                tokens: str = TOKENS, pieces: str = PIECES, text: str = "text") -> DataFrame:
    """``columns`` of each document with its counts, fertility and verdict ``kept``.

    A column of ``docs`` that is named like a result gives way to it.
    """
    names = [part.split()[0] for part in RULES.split(", ")]
    carried = [c for c in columns if c not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("judged_text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts = piece_ids(vocabulary_file(tokens)), pieces_of(vocabulary_file(pieces))
        for batch in slices(batches):
            results = [judge(x, memo, counts, bands) for x in texts_of(batch, "judged_text")]
            found = [pa.array(list(c)) for c in zip(*results)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(carried))] + found, carried + names)

    schema = ", ".join([f"`{c}` {source.schema[c].dataType.simpleString()}" for c in carried] + [RULES])
    return source.mapInArrow(measured, schema)
