"""License scans: a positional index of rare template words, in Spark's own functions.

The templates are public licence texts and the notices that refer to them. An index lists every
template word's places (word -> template, place). Rarity is measured: each template word's document
frequency is counted over all documents. In each text that has some key phrase's rarest word, its own
RARE licence words of highest IDF are looked up, and the AGREE rarest words of every key phrase, so
that each place where a key phrase stands is a candidate whatever the corpus's frequencies. Postings
are shifted by the word's place in the text; shifts on which AGREE words meet are candidate places of
a template. A candidate stands only if the template's mandatory key phrase is there word for word. Its
score is the part of the template's IDF weight that is found in place.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of all characters but \x00-\x2F, \x3A-\x40, \x5B-\x60 and \x7B-\x7F, A-Z lower-cased.
#: Each is named by itself: Java looks single characters up in a table, but tries ranges one after the other.
WORD = "[^" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    label: str
    key: str
    text: str

    @property
    def words(self) -> list[str]:
        return re.findall(r"[0-9a-z]+", self.text.lower())

    @property
    def offset(self) -> int:
        """Where in the words the key phrase stands."""
        own, key = self.words, self.key.split()
        return next(o for o in range(len(own)) if own[o : o + len(key)] == key)


#: Public licence texts and notices; key is a phrase of the text that must be there.
TEMPLATES = (
    Template("gpl", "gnu general public license", "This work is licensed under the GNU General Public License"),
    Template("apache", "apache license", "Licensed under the Apache License"),
    Template("cc-by", "cc by", "Licensed under CC BY"),
    Template("mit", "mit license", "Released under the MIT License"),
    Template("gpl-3.0", "gnu general public license version 3", "This work is licensed under the GNU General Public License, version 3."),
    Template("gpl-2.0", "gnu general public license version 2", "This work is licensed under the GNU General Public License, version 2."),
    Template("gpl-notice", "under the terms of the gnu general public license as published by the free software foundation", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    Template("lgpl", "gnu lesser general public license", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    Template("agpl", "gnu affero general public license", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("apache-2.0", "apache license version 2 0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    Template("cc-by-nc", "cc by nc", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-sa", "cc by sa", "Licensed under CC BY-SA 4.0."),
    Template("cc-by-nd", "cc by nd", "Licensed under CC BY-ND 4.0."),
    Template("cc-by-4.0", "cc by 4 0", "Licensed under CC BY 4.0."),
    Template("cc-attribution", "creative commons attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."),
    Template("mit-release", "under the mit license", "Released under the MIT License."),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    Template("bsd", "redistribution and use in source and binary forms", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    Template("isc", "permission to use copy modify and", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    Template("mpl", "mozilla public license", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    Template("epl", "eclipse public license", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    Template("unlicense", "free and unencumbered software", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    Template("zlib", "this software is provided as is without any express or implied warranty", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions."),
    Template("bsl-1.0", "boost software license", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
)
#: Licence words of highest IDF that are looked up in a text, the least IDF of those (in a tenth of all documents), and how many must agree on a place.
RARE, LEAST_IDF, AGREE = 12, math.log(10), 2


def _ascii_lower(word: Column) -> Column:
    """The word with A-Z lower-cased; one with any other character than ASCII letters and digits is no template's."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(word)


def _constant(value, kind: str) -> Column:
    """A nested constant, as one literal that the optimizer folds."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def vocabulary() -> list[str]:
    return sorted({w for t in TEMPLATES for w in t.words})


def frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Documents, and documents with each template word, in one scan of the whole table; one number per template word reaches the driver."""
    have = F.array_intersect(F.transform(words(F.col("text")), _ascii_lower), _constant(vocabulary(), "array<string>"))
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), have)).alias("w")).groupBy("w").count().collect()
    df = {r["w"]: r["count"] for r in rows}
    return df.pop("", 0), df


def rarity(n: int, df: dict[str, int]) -> dict[str, float]:
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-9 for w in vocabulary()}


def scan(docs: DataFrame) -> DataFrame:
    """Places of the base phrases, labels and score of all documents.

    A null or empty text has no words, no labels ("") and score 0. Places may overlap and all count.
    Labels are those of the base phrases and of all templates that stand; the score is the largest
    part of a template's IDF weight that stands, a template's key phrase alone being a small part of a
    long one. Of equal candidates any gives the same. A very long text is scanned whole. Rows that
    repeat an id are scanned each by itself. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n, df = frequencies(docs)
    idf = rarity(n, df)
    by_rarity = sorted((w for w in idf if idf[w] >= LEAST_IDF), key=lambda w: (-idf[w], w))
    postings: dict[str, list[tuple[int, int]]] = {}
    anchors: set[str] = set()
    triggers: set[str] = set()
    for i, t in enumerate(TEMPLATES):
        for j, w in enumerate(t.words):
            postings.setdefault(w, []).append((i, j))
        key = sorted(t.key.split(), key=lambda w: (-idf[w], w))
        anchors |= {*key[:AGREE], t.key.split()[0]}
        triggers.add(key[0])

    # without any key phrase's rarest word nothing can stand, and words are only counted
    empty = F.array().cast("array<string>")
    rows = docs.select("doc_id", F.transform(words(F.col("text")), _ascii_lower).alias("words"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.arrays_overlap("words", _constant(sorted(triggers), "array<string>")).alias("some"), "words")
    rows = rows.select("doc_id", "n_words", "some", F.when(F.col("some"), F.col("words")).otherwise(empty).alias("words"))
    own_rare = F.slice(F.array_intersect(_constant(by_rarity, "array<string>"), F.col("words")), 1, RARE)
    look = F.when(F.col("some"), F.array_union(own_rare, _constant(sorted(anchors), "array<string>"))).otherwise(empty)
    # a variable of its own, so that it is worked out once for a text and not for each word
    found = F.transform(F.array(look), lambda own: F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(own, w), F.struct(i.alias("i"), w.alias("w")))), lambda x: x.isNotNull()))
    at = F.get(found, F.lit(0))
    rows = rows.select("doc_id", "words", "n_words", at.alias("at"))

    def places(phrase: list[str]) -> Column:
        def rest(i: Column) -> Column:
            return reduce(lambda a, b: a & b, [F.coalesce(F.get(F.col("words"), i + k) == w, F.lit(False)) for k, w in enumerate(phrase) if k])

        return F.transform(F.filter("at", lambda x: (x["w"] == phrase[0]) & rest(x["i"])), lambda x: x["i"])

    rows = rows.select("*", *[places(p.split()).alias(f"base{k}") for k, p in enumerate(BASE)])

    # candidate places: posting lists, shifted and intersected by relative place
    table = _constant({w: [{"t": i, "j": j} for i, j in own] for w, own in sorted(postings.items())}, "map<string,array<struct<t:int,j:int>>>")
    votes = F.flatten(F.transform("at", lambda x: F.transform(F.coalesce(F.try_element_at(table, x["w"]), F.array().cast("array<struct<t:int,j:int>>")), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["j"]).alias("place")))))
    rows = rows.withColumn("votes", F.array_sort(votes))
    # equal votes stand side by side: the AGREE-th of a run makes a candidate
    candidates = F.filter(F.transform("votes", lambda v, k: F.when((k >= AGREE - 1) & (F.get(F.col("votes"), k - (AGREE - 1)) == v) & ((k < AGREE) | ~F.coalesce(F.get(F.col("votes"), k - AGREE) == v, F.lit(False))), v)), lambda v: v.isNotNull())
    rows = rows.withColumn("candidates", candidates).drop("votes", "at")

    weights = {t.label: [idf[w] / sum(idf[x] for x in t.words) for w in t.words] for t in TEMPLATES}
    every = _constant([{"label": t.label, "words": t.words, "weights": weights[t.label], "key": t.key.split(), "offset": t.offset} for t in TEMPLATES], "array<struct<label:string,words:array<string>,weights:array<double>,key:array<string>,offset:int>>")

    def stands(v: Column) -> Column:
        """The candidate's label and part, or null where its key phrase does not stand."""
        t, place = F.get(every, v["t"]), v["place"]
        begin = place + t["offset"]
        # single words are looked at: a slice would copy the whole text's words
        here = lambda i, w: F.coalesce(F.get(F.col("words"), i) == w, F.lit(False))
        key = F.forall(F.transform(t["key"], lambda w, k: here(begin + k, w)), lambda x: x)
        weights = F.transform(t["words"], lambda w, j: F.when(here(place + j, w), F.get(t["weights"], j)).otherwise(0.0))
        part = F.aggregate(weights, F.lit(0.0), lambda total, w: total + w)
        return F.when(key, F.struct(t["label"].alias("label"), F.least(part, F.lit(1.0)).alias("part")))

    rows = rows.withColumn("verified", F.filter(F.transform("candidates", stands), lambda x: x.isNotNull()))
    every_place = F.concat(*[F.col(f"base{k}") for k in range(len(BASE))])
    base = F.filter(F.array(*[F.when(F.size(f"base{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]), lambda x: x.isNotNull())
    return rows.select("doc_id", "n_words", every_place.alias("every"), base.alias("base"), "verified").select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.transform("verified", lambda x: x["label"]))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("verified", lambda x: x["part"])), F.lit(0.0)).alias("score"),
    )
