"""Licence notices by a positional index of rare words (operator 2).

Base: the places where the words of a phrase stand one after another.  Beyond that, whole notices are templates.  Phrases
are indexed by their rarest word, templates by all their words, with the places in them.  Of each template a file looks up
those words that it has, highest weight (inverse document frequency over all documents) first, until the weight looked up
is twice what a notice may lack; every hit says where the template would begin.  Beginnings on which enough of this weight
agrees are compared word by word, and count when the key phrase is there and the words in place carry ``least`` of
all the weight.  A notice that has this cannot be missed: what it lacks is less than what must agree.
"""

import math
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from deskflow.llm.common import AT_ONCE, per_text, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Phrase and label of the base.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, mandatory key phrase, and the notice as usually worded.
TEMPLATES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license",
     "it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("agpl", "affero general public license", "under the terms of the gnu affero general public license"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software",
     "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("unlicense", "released into the public domain",
     "this is free and unencumbered software released into the public domain"),
    ("cc-by", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-sa", "cc by nc sa 4 0", "licensed under cc by nc sa 4 0"),
    # Whole notices, from behind the line that names the holder.
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", """
     Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
     rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
     persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
     this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
     "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
     FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
     CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
     CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", "permission to use copy modify and or distribute this software", """
     Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
     provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
     AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
     AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
     DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
     TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", "redistribution and use in source and binary forms", """
     Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
     conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and
     the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
     conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("apache", "licensed under the apache license version 2 0", """
     Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
     License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
     law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES
     OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
     limitations under the License."""),
    ("gpl", "terms of the gnu general public license as published by the free software foundation", """
     This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
     as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
     program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
     received a copy of the GNU General Public License along with this program."""),
    ("mpl", "subject to the terms of the mozilla public license", """
     This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
     distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("zlib", "this software is provided as is without any express or implied warranty", """
     This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
     any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
     including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""),
    ("unlicense", "released into the public domain", """
     This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
     compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
     or non-commercial, and by any means."""),
)

_WORD = rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased: digits, letters a-z and all that is not ASCII."""
    return re.findall(_WORD, (text or "").encode().lower())


def worded(text: str) -> list[str]:
    return [w.decode() for w in words_of(text)]


def vocabulary(templates=TEMPLATES, phrases=PHRASES) -> list[str]:
    """All words of phrases and templates, in order."""
    return sorted({w for _, _, t in templates for w in worded(t)} | {w for p, _ in phrases for w in worded(p)})


def document_frequencies(docs: DataFrame, vocab: list[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Rows of the table, and in how many of them each word of the (bounded) vocabulary stands."""
    wanted = {w.encode(): i for i, w in enumerate(vocab)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = [0] * len(wanted), 0
        for batch in batches:
            rows += batch.num_rows
            for start in range(0, batch.num_rows, AT_ONCE):
                for text in batch.column(0).slice(start, AT_ONCE).to_pylist():
                    for w in wanted.keys() & words_of(text):
                        seen[wanted[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(seen))], pa.int32()),
                                          pa.array([rows, *seen], pa.int64())], ["w", "n"])

    found = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "w int, n long")
    got = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.sum("n").alias("n")).collect()}
    return got.get(-1, 0), {w: got.get(i, 0) for i, w in enumerate(vocab)}


class _Template:
    """Words of a template with their places, weights, and the places of its key phrase."""

    def __init__(self, label: str, key: str, text: str, weight: dict[str, float]):
        words, inner = worded(text), worded(key)
        at = next((i for i in range(len(words)) if words[i:i + len(inner)] == inner), None)
        if at is None or not inner:
            raise ValueError(f"key phrase {key!r} is not in the template of {label}")
        self.label, self.words = label, [w.encode() for w in words]
        self.weights = [weight[w] for w in words]
        self.total = sum(self.weights)
        self.key = range(at, at + len(inner))
        self.key_words = {w.encode() for w in inner}
        self.places: dict[bytes, list[int]] = {}
        for q, w in enumerate(self.words):
            self.places.setdefault(w, []).append(q)
        # Rarest first.
        self.ranked = sorted(self.places, key=lambda w: (-weight[w.decode()], w))
        self.carried = {w: weight[w.decode()] * len(self.places[w]) for w in self.places}


def _scanner(templates, phrases, weight: dict[str, float], least: float):
    known = [_Template(label, key, t, weight) for label, key, t in templates]
    vocab = {w for t in known for w in t.places}
    exact: dict[bytes, list[tuple[str, list[bytes], int]]] = {}
    for p, label in phrases:
        words = worded(p)
        q = min(range(len(words)), key=lambda i: (-weight[words[i]], i))
        exact.setdefault(words[q].encode(), []).append((label, [w.encode() for w in words], q))

    def beginnings(t: _Template, at: dict[bytes, list[int]]) -> list[int]:
        """Where the template may begin: what is looked up agrees but for as much as may be lacking."""
        lacking = t.total * (1 - least) + 1e-9 * t.total - sum(x for w, x in t.carried.items() if w not in at)
        if lacking < 0:
            return []
        votes: dict[int, float] = {}
        looked = 0.0
        for w in t.ranked:
            if looked > 2 * lacking:
                break
            if w in at:
                looked += t.carried[w]
                each = t.carried[w] / len(t.places[w])
                for q in t.places[w]:
                    for p in at[w]:
                        votes[p - q] = votes.get(p - q, 0.0) + each
        return sorted(start for start, agreed in votes.items() if agreed >= looked - lacking - 1e-9 * t.total)

    def scan(words: list[bytes]) -> list[dict]:
        out = []
        there = set(words)
        for p, w in enumerate(words) if not exact.keys().isdisjoint(there) else ():
            for label, phrase, q in exact.get(w, ()):
                if p >= q and words[p - q:p - q + len(phrase)] == phrase:
                    out.append({"label": label, "base": True, "first": p - q, "words": len(phrase), "share": 1.0})
        possible = [t for t in known if t.key_words <= there]
        if possible:
            at: dict[bytes, list[int]] = {}
            for p, w in enumerate(words):
                if w in vocab:
                    at.setdefault(w, []).append(p)
            for t in possible:
                for start in beginnings(t, at):
                    same = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)]
                    share = sum(x for x, ok in zip(t.weights, same) if ok) / t.total
                    if all(same[j] for j in t.key) and share >= least:
                        out.append({"label": t.label, "base": False, "first": start, "words": len(same), "share": share})
        return out

    return scan


def _scans(*args):
    scan = _scanner(*args)

    def work(texts):
        words = [words_of(t) for t in texts]
        return {"n_words": [len(w) for w in words], "places": [scan(w) for w in words]}

    return work


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
             least: float = 0.8) -> DataFrame:
    """(id, n_words, places) of every row; a place has label, base, first word, words, and share of weight in place.

    A place is every beginning of a template whose key phrase stands there and whose words in place have ``least`` of the
    weight.  Null and empty texts have no words and no places; repeated rows stay repeated; a table without rows gives none.
    ``first`` of a template may be negative by as many words as the text lacks at its head.
    """
    vocab = vocabulary(templates, phrases)
    rows_n, df = document_frequencies(docs, vocab, text_col)
    weight = {w: math.log((rows_n + 1) / (df[w] + 0.5)) + 1e-9 if rows_n else 1.0 for w in vocab}
    weight = {w: max(x, 1e-9) for w, x in weight.items()}
    rows = texts_of(docs, id_col, text_col)
    kind = "n_words long, places array<struct<label:string,base:boolean,first:int,words:int,share:double>>"
    found = per_text(lambda: _scans(templates, phrases, weight, least), kind, F.col("text"))
    return rows.select("id", found.alias("x")).select("id", "x.n_words", "x.places")
