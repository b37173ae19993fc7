"""Licences in texts by a positional index of rare words.

The index maps each licence word to its places in the templates. A text is read in
stretches; of each the licence words that the fewest documents of the corpus have are
looked up, and each template's own rarest words wherever they stand. A word votes for
the place where the template would start. Where two words agree on a place, to a few
words, the template is a candidate there: its mandatory phrases must stand in full and
most of its words in order. What no rare words point at is not looked at.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases, and wordings of common licences with their mandatory phrases.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    ("mit", "released under the terms of the mit license", ("mit license",)),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file"
        " except in compliance with the license you may obtain a copy of the license at",
        ("apache license version 2",),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this"
        " permission notice appear in all copies",
        ("permission to use copy modify",),
    ),
    (
        "gpl-3",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation either"
        " version 3 of the license or at your option any later version",
        ("gnu general public license", "version 3"),
    ),
    (
        "gpl-3",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    (
        "gpl-2",
        "licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    (
        "lgpl",
        "licensed under the gnu lesser general public license",
        ("gnu lesser general public license",),
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    (
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ("attribution noncommercial",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        ("attribution sharealike",),
    ),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    (
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ("attribution 4 0",),
    ),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software the software is provided as is without warranty of"
        " any kind express or implied including but not limited to the warranties of"
        " merchantability fitness for a particular purpose and noninfringement in no event shall"
        " the authors or copyright holders be liable for any claim damages or other liability",
        ("substantial portions of the software",),
    ),
    (
        "apache-2",
        "unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind"
        " either express or implied see the license for the specific language governing"
        " permissions and limitations under the license",
        ("unless required by applicable law", "specific language governing"),
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer 2 redistributions in binary form must reproduce"
        " the above copyright notice this list of conditions and the following disclaimer in the"
        " documentation and or other materials provided with the distribution",
        ("redistributions of source code must retain", "redistributions in binary form"),
    ),
    (
        "bsd-3",
        "neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission",
        ("neither the name", "endorse or promote products"),
    ),
    (
        "agpl-3",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu affero general public license as published by the free software foundation"
        " either version 3 of the license or at your option any later version",
        ("gnu affero general public license", "version 3"),
    ),
    (
        "gpl-2",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation either"
        " version 2 of the license or at your option any later version",
        ("gnu general public license", "version 2"),
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms"
        " of the gnu lesser general public license as published by the free software foundation"
        " either version 2 1 of the license or at your option any later version",
        ("gnu lesser general public license",),
    ),
    (
        "epl-2",
        "this program and the accompanying materials are made available under the terms of the"
        " eclipse public license 2 0 which is available at",
        ("eclipse public license",),
    ),
    (
        "cddl",
        "the contents of this file are subject to the terms of the common development and"
        " distribution license you may not use this file except in compliance with the license",
        ("common development and distribution license",),
    ),
    (
        "cc0",
        "to the extent possible under law the author s have dedicated all copyright and related"
        " and neighboring rights to this software to the public domain worldwide",
        ("copyright and related and neighboring rights", "public domain"),
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will"
        " the authors be held liable for any damages arising from the use of this software"
        " permission is granted to anyone to use this software for any purpose including"
        " commercial applications and to alter it and redistribute it freely",
        ("damages arising from the use of this software", "including commercial applications"),
    ),
    (
        "bsl-1",
        "permission is hereby granted free of charge to any person or organization obtaining a"
        " copy of the software and accompanying documentation covered by this license the"
        " software to use reproduce display distribute execute and transmit the software",
        ("any person or organization", "reproduce display distribute execute"),
    ),
    (
        "ofl-1",
        "this font software is licensed under the sil open font license version 1 1",
        ("sil open font license",),
    ),
    (
        "postgresql",
        "permission to use copy modify and distribute this software and its documentation for any"
        " purpose without fee and without a written agreement is hereby granted provided that the"
        " above copyright notice and this paragraph and the following two paragraphs appear in all"
        " copies",
        ("without a written agreement",),
    ),
    (
        "wtfpl",
        "everyone is permitted to copy and distribute verbatim or modified copies of this license"
        " document and changing it is allowed as long as the name is changed",
        ("verbatim or modified copies of this license document",),
    ),
    (
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either"
        " in source code form or as a compiled binary for any purpose commercial or non commercial"
        " and by any means",
        ("anyone is free to copy modify publish",),
    ),
)
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

# Words of a stretch, and how many of its licence words are looked up, the rarest first.
STRETCH = 32
RAREST_WORDS = 3
# Words of each template that are looked up in every stretch, its rarest.
KEY_WORDS = 3
# Votes of one template this many places apart count together: a word more or less.
SLACK = 3
LEAST_SCORE = 0.8
# Cells between two templates' votes: more than a text has words, before and after.
CELLS = 1 << 40


class Index:
    """Templates as words, and places of each licence word in them."""

    def __init__(self, templates=TEMPLATES) -> None:
        self.templates = [
            (label, text.split(), [p.split() for p in phrases])
            for label, text, phrases in templates
        ]
        self.places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, words, _) in enumerate(self.templates):
            for at, word in enumerate(words):
                self.places[word].append((n, at))


class Lookup:
    """The index as it is looked up in a corpus: words ranked by how few documents have them.

    A vote is one whole number: the template's base and the place in the text where it
    would start, in cells of SLACK words.
    """

    def __init__(self, index: Index, idf: dict[str, float]) -> None:
        self.index = index
        ranked = sorted(index.places, key=lambda w: (-idf.get(w, math.inf), w))
        self.rank = {w: i for i, w in enumerate(ranked)}
        self.offsets = {
            w: [n * CELLS * SLACK - at for n, at in places] for w, places in index.places.items()
        }
        # A word's places in the templates of which it is one of the rarest.
        self.keys: dict[str, list[int]] = defaultdict(list)
        self.one_word = set()
        for n, (_, words, _) in enumerate(index.templates):
            own = sorted(set(words), key=self.rank.get)
            if len(own) == 1:
                self.one_word.add(n)
            for w in own[:KEY_WORDS]:
                self.keys[w] += [n * CELLS * SLACK - at for at, x in enumerate(words) if x == w]

    def candidates(self, words: list[str]) -> dict[int, list[int]]:
        """template -> cells in which two of the looked-up words agree, in order."""
        rank, most = self.rank, RAREST_WORDS
        stretches: dict[int, dict[str, list[int]]] = {}
        for i, w in enumerate(words):
            if w in rank:
                stretches.setdefault(i // STRETCH, {}).setdefault(w, []).append(i)
        agreed: set[int] = set()
        last, near = -2, set()
        for number, found in stretches.items():
            # Words on both sides of a stretch's end agree too.
            if number != last + 1:
                near = set()
            looked_up = [
                (self.offsets[w] if n < most else self.keys[w], found[w])
                for n, w in enumerate(sorted(found, key=rank.get))
                if n < most or w in self.keys
            ]
            # Few places first: the many are only compared with cells beside those seen.
            looked_up.sort(key=lambda x: len(x[0]) * len(x[1]))
            seen: set[int] = set()
            for offsets, at in looked_up:
                votes = {(i + x) // SLACK for i in at for x in offsets}
                agreed |= votes & near
                if self.one_word:
                    agreed |= {v for v in votes if (v + CELLS // 2) // CELLS in self.one_word}
                beside = votes | {v + 1 for v in votes} | {v - 1 for v in votes}
                near = near | beside
                seen |= beside
            last, near = number, seen
        by_template: dict[int, list[int]] = defaultdict(list)
        for v in sorted(agreed):
            template = (v + CELLS // 2) // CELLS
            by_template[template].append(v - template * CELLS)
        return by_template


def lowered(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lowered(text or ""))


def places_of(phrase: list[str], words: list[str], start: int = 0, end: int | None = None) -> list[int]:
    end = len(words) if end is None else end
    found, at = [], start
    while True:
        try:
            at = words.index(phrase[0], at, end)
        except ValueError:
            return found
        if at + len(phrase) <= end and words[at : at + len(phrase)] == phrase:
            found.append(at)
        at += 1


def _common_words(a: list[str], b: list[str]) -> int:
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        above_left = 0
        for j, y in enumerate(b, 1):
            above_left, row[j] = row[j], above_left + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def matches(words: list[str], lookup: Lookup) -> dict[str, float]:
    """label -> best score of its templates, for those that hold."""
    found: dict[str, float] = {}
    for template, cells in lookup.candidates(words).items():
        label, expected, phrases = lookup.index.templates[template]
        best, passed = found.get(label, 0.0), None
        for cell in cells:
            if best == 1:
                break
            # The cell before covers this one's places.
            if passed == cell - 1:
                passed = None
                continue
            passed = cell
            start = max(0, (cell - 2) * SLACK)
            end = min(len(words), (cell + 3) * SLACK + len(expected) + SLACK)
            if all(places_of(p, words, start, end) for p in phrases):
                best = max(best, _common_words(expected, words[start:end]) / len(expected))
        if best >= LEAST_SCORE:
            found[label] = best
    return found


def document_frequencies(docs: DataFrame, index: Index) -> dict[str, float]:
    """Inverse document frequency of each licence word, over all documents.

    One row per licence word reaches the driver, however many documents there are.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, of = index.places.keys(), 0, dict.fromkeys(index.places, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                for w in known & set(words_of(text)):
                    of[w] += 1
        names = ["", *of]
        yield pa.RecordBatch.from_pydict({"word": names, "n": [n, *of.values()]})

    rows = (
        docs.select("text")
        .mapInArrow(counted, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    seen = {r["word"]: r["n"] for r in rows}
    n = seen.pop("", 0)
    return {w: math.log((n + 1) / (df + 1)) for w, df in seen.items()}


def _judged(text: str | None, lookup: Lookup, base: list) -> dict:
    words = words_of(text)
    places, base_labels = [], set()
    for phrase, label in base:
        if at := places_of(phrase, words):
            places += at
            base_labels.add(label)
    found = matches(words, lookup)
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | set(found))),
        "score": 1.0 if base_labels else max(found.values(), default=0.0),
    }


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)
COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double"
)


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per row of docs: the columns in COLUMNS.

    A null or empty text has no words, no labels and score 0. Null ids and
    repeated rows stay rows of their own; other columns are left out. The score is
    1 with a base phrase, else the best template's share of words found in order.
    """
    index = Index(templates)
    lookup = Lookup(index, document_frequencies(docs, index))
    base = [(phrase.split(), label) for phrase, label in BASE]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"doc_id": doc_id, **_judged(text, lookup, base)}
                for doc_id, text in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(judged, COLUMNS)
