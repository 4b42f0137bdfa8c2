"""Licence scan by a positional rare-token index (operator 6), DataFrame functions only.

The index holds, for every template (a short licence notice), the relative positions of
the words of its mandatory key phrases.  For a file the words with the highest IDF are
looked up; the places they stand at, less their positions in the template, are the
possible alignments, and only alignments on which the template's rare words agree are
left.  An alignment counts if every mandatory key phrase stands there word for word and
at least ``LEAST_SHARE`` of the template's words agree; that share is its score.

The IDF of the licence words comes from all files of the table (one aggregate, a row a
word).  It decides which words are looked up first, never which places are found: the key
phrases are verified in full.  Words are runs of ASCII letters and digits and all
characters beyond ASCII, with A-Z in lower case.

Defined results: a null text has no words, labels or places (score 0); texts of any length
are scanned whole; repeated rows give equal results; labels are distinct and sorted; an
empty table gives an empty result.  Only key and text are read.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Fixed values: (label, notice, mandatory key phrases), in lower case without punctuation.
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published "
            "by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files", ["permission is hereby granted free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify and or distribute this software"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("cc0", "creative commons cc0 1 0 universal public domain dedication", ["cc0 1 0 universal"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("proprietary", "all rights reserved", ["all rights reserved"]),
    # whole notices, as far as they don't vary
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
               "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
               "to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any "
               "kind either express or implied see the license for the specific language governing permissions and limitations under the license",
     ["apache license", "except in compliance with the license", "without warranties or conditions of any kind"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution",
     ["redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce"]),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without "
                     "specific prior written permission", ["names of its contributors may be used to endorse or promote products"]),
    ("gpl-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                         "license as published by the free software foundation either version 2 of the license or at your option any later version",
     ["gnu general public license", "either version 2 of the license"]),
    ("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                         "license as published by the free software foundation either version 3 of the license or at your option any later version",
     ["gnu general public license", "either version 3 of the license"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
             "as published by the free software foundation either version 2 1 of the license or at your option any later version",
     ["gnu lesser general public license", "free software foundation"]),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license "
             "as published by the free software foundation either version 3 of the license or at your option any later version",
     ["gnu affero general public license", "free software foundation"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
            "this file you can obtain one at http mozilla org mpl 2 0", ["mozilla public license", "if a copy of the mpl was not distributed"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
            "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software", ["permission is hereby granted free of charge", "sublicense and or sell copies", "copies or substantial portions"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
            "the above copyright notice and this permission notice appear in all copies",
     ["copy modify and or distribute this software", "this permission notice appear in all copies"]),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
             "redistribute it freely subject to the following restrictions", ["permission is granted to anyone to use this software"]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ["eclipse public license"]),
    ("bsl", "distributed under the boost software license version 1 0", ["boost software license"]),
]
LEAST_SHARE = 0.5
#: Words of a template, those of highest IDF, that must agree on an alignment.
RARE = 2

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[int, tuple[str, ...]], ...]  # (position in the template, words)

    @classmethod
    def of(cls, label: str, notice: str, phrases: list[str]) -> Template:
        words = tuple(notice.split())
        placed = []
        for p in phrases:
            p = tuple(p.split())
            at = next(i for i in range(len(words)) if words[i:i + len(p)] == p)
            placed.append((at, p))
        return cls(label, words, tuple(placed))

    def postings(self) -> list[tuple[str, int]]:
        """(word, position) of every word of the key phrases."""
        return [(w, at + j) for at, p in self.phrases for j, w in enumerate(p)]

    def rare(self, idf: dict[str, float]) -> list[tuple[str, int]]:
        """Its ``RARE`` postings of highest IDF, ties to the earlier word."""
        return sorted(self.postings(), key=lambda x: (-idf[x[0]], x[1]))[:RARE]


TEMPLATES_ = [Template.of(*t) for t in TEMPLATES]
PHRASES_ = [Template.of(label, p, [p]) for p, label in PHRASES.items()]
#: All words of the index.
LICENCE_WORDS = sorted({w for t in TEMPLATES_ + PHRASES_ for w, _ in t.postings()})


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case."""
    # lower() is the faster way; only two characters beyond ASCII have ASCII in their lower case
    lower = F.when(text.rlike("[\u212A\u0130]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    return F.filter(F.split(lower, WORD.replace("[", "[^") + "+"), lambda w: w != "")


def holds(text: Column, words: list[str]) -> Column:
    """Does any of the words stand in the text?  (Java's (?i) folds ASCII letters only.)"""
    return text.rlike(rf"(?i)(?<!{WORD})(?:{'|'.join(map(re.escape, words))})(?!{WORD})")


def inverse_frequencies(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """IDF of the licence words over all files: one row a word reaches the driver."""
    t = docs.select(docs[text].alias("t")).where("t is not null")
    index = F.array(*map(F.lit, LICENCE_WORDS))
    found = t.select(F.explode(F.array_intersect(words_of(F.col("t")), index)).alias("w"))
    files = {r["w"]: r["count"] for r in found.groupBy("w").count().collect()}
    total = t.count()
    return {w: math.log((total + 1) / (files.get(w, 0) + 1)) for w in LICENCE_WORDS}


def _stands(words: Column, at: Column, phrase: tuple[str, ...]) -> Column:
    """The phrase stands in the words from place ``at`` on, word for word."""
    return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.lit(len(phrase))) == F.array(*map(F.lit, phrase)))


def _alignments(hits: Column, template: Template, idf: dict[str, float]) -> Column:
    """Where the template would have to start for its rare words to stand where they do."""
    def starts(word: str, position: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["i"] - position)

    lists = [starts(w, p) for w, p in template.rare(idf)]
    out = lists[0]
    for other in lists[1:]:
        out = F.array_intersect(out, other)
    return F.array_distinct(out)


def scan(docs: DataFrame, idf: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, n_words, places array<int> of base phrases, base_labels, labels, score)."""
    d = docs.select(docs[key].alias("k"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    gate = sorted({t.rare(idf)[0][0] for t in TEMPLATES_ + PHRASES_})  # a file without the rarest words has no template
    d = d.select("k", F.regexp_count("t", F.lit(WORD + "+")).cast("long").alias("n_words"),
                 F.when(holds(F.col("t"), gate), words_of(F.col("t"))).otherwise(F.array().cast("array<string>")).alias("words"))
    index = F.array(*map(F.lit, LICENCE_WORDS))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(index, h["w"]))
    d = d.select("k", "n_words", "words", hits.alias("hits"))
    words = F.col("words")

    def base(t: Template) -> Column:
        phrase = t.phrases[0][1]
        return F.filter(_alignments(F.col("hits"), t, idf), lambda a: _stands(words, a, phrase))

    def share(t: Template) -> Column:
        """The best share of agreeing words over the verified alignments; null: none."""
        def verified(a):
            ok = F.lit(True)
            for at, phrase in t.phrases:
                ok = ok & _stands(words, a + at, phrase)
            return ok

        def agreeing(a):
            n = F.lit(0)
            for j, w in enumerate(t.words):
                n = n + F.when((a + j >= 0) & (F.get(words, a + j) == w), 1).otherwise(0)
            return n / F.lit(float(len(t.words)))

        return F.array_max(F.transform(F.filter(_alignments(F.col("hits"), t, idf), verified), agreeing))

    d = d.select("k", "n_words", *[base(t).alias(f"p{i}") for i, t in enumerate(PHRASES_)],
                 *[share(t).alias(f"s{i}") for i, t in enumerate(TEMPLATES_)])
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(t.label)) for i, t in enumerate(PHRASES_)]))
    own = F.array_compact(F.array(*[F.when(F.col(f"s{i}") >= LEAST_SHARE, F.lit(t.label)) for i, t in enumerate(TEMPLATES_)]))
    score = F.array_max(F.array(*[F.when(F.col(f"s{i}") >= LEAST_SHARE, F.col(f"s{i}")) for i in range(len(TEMPLATES_))]))
    return d.select(
        "k", "n_words", F.concat(*[f"p{i}" for i in range(len(PHRASES_))]).alias("places"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"))


def oracle() -> str:
    """DuckDB SQL for the query's rows, from the templates alone: it tries every place."""
    def stands(at: str, phrase) -> str:
        return "(" + " AND ".join(f"ws[{at} + {j + 1}] = '{w}'" for j, w in enumerate(phrase)) + ")"

    places, shares = [], []
    for i, t in enumerate(PHRASES_):
        places.append(f"list_filter(range(len(ws)), lambda a: {stands('a', t.phrases[0][1])}) AS p{i}")
    for i, t in enumerate(TEMPLATES_):
        first = t.phrases[0][0]  # the first key phrase has to stand inside the text
        ok = " AND ".join(stands(f"a + {at}", p) for at, p in t.phrases)
        same = " + ".join(f"CASE WHEN a + {j} >= 0 AND ws[a + {j + 1}] = '{w}' THEN 1 ELSE 0 END" for j, w in enumerate(t.words))
        shares.append(f"list_max(list_transform(list_filter(range(-{first}, len(ws) - {first}), lambda a: a + {first} >= 0 AND {ok}), "
                      f"lambda a: ({same}) / {len(t.words)}.0::DOUBLE)) AS s{i}")
    base = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{t.label}' END" for i, t in enumerate(PHRASES_))
    own = ", ".join(f"CASE WHEN s{i} >= {LEAST_SHARE} THEN '{t.label}' END" for i, t in enumerate(TEMPLATES_))
    joined = lambda parts: (f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{parts}], lambda x: x IS NOT NULL))), ','), '')")
    every = " || ".join(f"p{i}" for i in range(len(PHRASES_)))
    best = ", ".join(f"CASE WHEN s{i} >= {LEAST_SHARE} THEN s{i} END" for i in range(len(TEMPLATES_)))
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
      f AS (SELECT doc_id, len(ws) AS n_words, {", ".join(places)}, {", ".join(shares)} FROM w)
      SELECT doc_id, n_words, len({every}) AS n_base, list_min({every}) AS first_word, list_max({every}) AS last_word,
        {joined(base)} AS base_labels, {joined(base + ", " + own)} AS labels, coalesce(list_max([{best}]), 0.0)::DOUBLE AS score FROM f"""
