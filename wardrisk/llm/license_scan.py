"""Licence scan with a positional index of rare words, in DataFrame functions only.

Every file keeps the positions of its licence words (the words of any template).  Document frequencies over all files
weigh them.  A file that has all words of a template's mandatory phrase looks up where the one of highest IDF stands;
shifting each position by the word's place in the template turns postings into possible starts, and intersecting them
with the starts of the other words of the phrase, the rarer ones first, leaves the places where it stands word for word.
The mandatory phrase alone decides the label, so a file's labels are the same in any corpus; the weights order the
look-up, and they make the score: the share of the template's weight that stands in place around the phrase.  Base phrases
are templates that are mandatory as a whole, so all their places are found.

Only rows per licence word (bounded by the templates) reach the driver; there is no join, so no key
can be hot, and repeated ids do not meet.

Defined results: a null text is empty, with no words, no labels and score 0; letters other than A-Z
that a lower-casing would turn into ASCII stay apart from it; repeated rows are scanned each; an
empty table gives no rows; columns other than those asked for are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored


class Template(NamedTuple):
    label: str
    words: str
    #: The part that must stand there word for word; the whole template where empty.
    mandatory: str = ""


#: Phrases and labels whose places are counted (fixed values).
BASE = (Template("mit", "under the mit license"), Template("apache-2", "apache license version 2"),
        Template("cc-by-nc", "cc by nc"))
#: Passages of well-known licences (fixed values), each with its mandatory phrase.
METHOD = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
             " license as published by the free software foundation", "gnu general public license"),
    Template("gpl", "gnu general public license version 3", "gnu general public license"),
    Template("gpl", "gnu general public license version 2", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
             " distributed with this file you can obtain one", "mozilla public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
             " documentation files the software to deal in the software without restriction",
             "free of charge to any person obtaining a copy"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the"
             " following conditions are met", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
             " provided that the above copyright notice and this permission notice appear in all copies",
             "for any purpose with or without fee"),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
             " use compile sell or distribute this software", "unencumbered software released into the public domain"),
    Template("cc-by", "this work is licensed under a creative commons attribution international license", "creative commons attribution"),
    Template("cc-by-sa", "cc by sa"),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
             " the license", "apache license version 2"),
)

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters whose lower case has ASCII letters: the Kelvin sign and the dotted capital I.
TO_ASCII = "Kİ"


def words_of(text: Column) -> Column:
    """The words of a text after lower-casing A-Z."""
    apart = reduce(lambda column, letter: F.replace(column, F.lit(letter), F.lit("ß")), TO_ASCII, F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(F.lower(apart), SEPARATORS), "")


def licence_words(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words.split()})


def positions(docs: DataFrame, columns: Sequence[str], templates: Sequence[Template], text: str = "text") -> DataFrame:
    """``columns``, ``n_words`` and ``hits``: position and word of every licence word of a file."""
    lexicon = licence_words(templates)

    def hit(word, place):
        return F.when(word.isin(lexicon), F.struct(place.cast("long").alias("p"), word.alias("w")))

    words = docs.select(*[F.col(f"`{c}`") for c in columns], words_of(F.col(f"`{text}`").cast("string")).alias("words_"))
    return words.select(*[F.col(f"`{c}`") for c in columns], F.size("words_").cast("long").alias("n_words"),
                        F.filter(F.transform("words_", hit), lambda h: h.isNotNull()).alias("hits"))


def inverse_frequencies(hits: DataFrame, templates: Sequence[Template]) -> dict[str, float]:
    """IDF of each licence word over all files."""
    files = hits.count()
    found = (hits.select(F.explode(F.array_distinct("hits.w")).alias("w")).groupBy("w").count()
             .collect())  # one row per licence word at most
    counts = {r["w"]: r["count"] for r in found}
    return {w: math.log((files + 1) / (counts.get(w, 0) + 1)) + 1.0 for w in licence_words(templates)}


def scan(docs: DataFrame, columns: Sequence[str] = ("doc_id",), text: str = "text",
         base: Sequence[Template] = BASE, method: Sequence[Template] = METHOD) -> DataFrame:
    """``columns`` of each file with its word count, the places of base phrases, its labels and a score."""
    everything = [*base, *method]
    hits = stored(positions(docs, columns, everything, text), "licence-words")
    idf = inverse_frequencies(hits, everything)

    def starts(word: str, place: int) -> Column:
        own = F.filter("hits", lambda h: h["w"] == word)
        return F.transform(own, lambda h: h["p"] - F.lit(place))

    def meet(places: Sequence[tuple[str, int]]) -> Column:
        """Starts that agree for all the words, the rarest first."""
        ordered = sorted(places, key=lambda x: -idf[x[0]])
        return reduce(F.array_intersect, [starts(*x) for x in ordered])

    none = F.array().cast("array<bigint>")
    results, shares = hits.withColumn("seen", F.array_distinct("hits.w")), []
    for i, template in enumerate(everything):
        words, phrase = template.words.split(), (template.mandatory or template.words).split()
        at = next(k for k in range(len(words)) if words[k:k + len(phrase)] == phrase)
        needed = {(w, at + k) for k, w in enumerate(phrase)}
        rarest = sorted({w for w, _ in needed}, key=lambda w: -idf[w])
        looked_up = reduce(lambda a, b: a & b, [F.array_contains("seen", w) for w in rarest])
        results = results.withColumn(f"places{i}", F.when(looked_up, meet(sorted(needed))).otherwise(none))
        total = sum(idf[w] for w in words)
        held = [F.when(F.arrays_overlap(starts(w, k), F.col(f"places{i}")), idf[w] / total).otherwise(0.0)
                for k, w in enumerate(words) if (w, k) not in needed]
        share = reduce(lambda a, b: a + b, held, F.lit(sum(idf[w] for w, _ in needed) / total))
        shares.append(F.when(F.size(f"places{i}") > 0, F.least(share, F.lit(1.0))).otherwise(0.0))
    results = results.select(*[F.col(f"`{c}`") for c in columns], "n_words",
                             *[F.col(f"places{i}") for i in range(len(base))],
                             *[s.alias(f"share{i}") for i, s in enumerate(shares)])

    def joined(picked: Sequence[tuple[int, str]]) -> Column:
        labels = F.array(*[F.when(F.col(f"share{i}") > 0, F.lit(label)) for i, label in picked])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(labels))), ",")

    numbered = [(i, t.label) for i, t in enumerate(everything)]
    places = F.concat(none, *[F.col(f"places{i}") for i in range(len(base))])
    return results.select(
        *[F.col(f"`{c}`") for c in columns], "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(numbered[:len(base)]).alias("base_labels"), joined(numbered).alias("labels"),
        F.round(F.greatest(F.lit(0.0), *[F.col(f"share{i}") for i, _ in numbered]), 6).alias("score"))
