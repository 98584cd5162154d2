"""License scans: a positional index of rare words, aligned by relative position and verified by key phrases.

The index holds, for every template, its rarest words over the corpus (highest inverse document frequency) with their places. A
text's words that the index knows are looked up; a posting (template, place in template) at a place in the text votes for the
template's start there. Starts with enough votes are candidates, and a candidate stands when the template's key phrases occur in
the window it covers. A template needs no more votes than the indexed words of its shortest key phrase can give, so a mention that
holds only the phrase is a candidate too; a template with a key phrase whose words are not all in the corpus can stand nowhere and is
left out. Everything after the frequency count is a scan of built-in functions: postings are literals, since they number a few
per template, and no text leaves its row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptloom.llm.common import hold, let, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """A licence sentence: its label, its words, and the phrases without which it does not count."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return self.text.split()


TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
             ("except in compliance with the license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ("permission is hereby granted", "free of charge")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("with or without fee",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use", "binary forms")),
    Template("gpl", "this work is licensed under the gnu general public license", ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
             ("free software", "gnu general public license")),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("attribution sharealike",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("proprietary", "unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential",
             ("strictly prohibited",)),
    # Whole licences.
    Template("mit", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the
software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this
permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or
implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or
copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with
the software or the use or other dealings in the software""", ("substantial portions of the software", "provided as is")),
    Template("isc", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the
above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this
software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or
in connection with the use or performance of this software""", ("author disclaims all warranties", "other tortious action")),
    Template("bsd", """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must
reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution""", ("redistributions of source code must retain", "redistributions in binary form must reproduce")),
    Template("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising
from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute
it freely subject to the following restrictions the origin of this software must not be misrepresented""", ("redistribute it freely", "must not be misrepresented")),
)


def folded(text: Column) -> Column:
    """Only A-Z become lower case. ``lower`` agrees with that on texts without other characters, which are most."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(folded(text), F.lit(WORD), F.lit(0))


def document_frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each word, over all documents. At most one count per word of the templates
    reaches the driver."""
    found = F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    counts = {r["w"]: r["n"] for r in counted}
    return counts.pop("", 0), counts


def rare_postings(documents: int, counts: dict[str, int], templates=TEMPLATES, rare: int = 8) -> dict[str, list[tuple[int, int]]]:
    """word -> [(template number, place)] for the ``rare`` words of each template with the highest inverse document frequency, and the rarest
    word of each of its key phrases. Words that no document holds are not ranked; a template with one in a key phrase has no postings.
    Of equally frequent words the one in fewer templates comes first, then the longer, then the alphabetically smaller."""
    spread = {w: sum(w in t.words for t in templates) for t in templates for w in t.words}
    idf = lambda w: math.log((documents + 1) / (counts[w] + 1))
    rank = lambda w: (-idf(w), spread[w], -len(w), w)
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        if not all(w in counts for p in template.phrases for w in p.split()):
            continue
        ranked = sorted({w for w in template.words if w in counts}, key=rank)
        for w in sorted({*ranked[:rare], *(min(p.split(), key=rank) for p in template.phrases)}, key=rank):
            index.setdefault(w, []).extend((number, place) for place, x in enumerate(template.words) if x == w)
    return index


def needed_votes(index: dict[str, list[tuple[int, int]]], templates=TEMPLATES, votes: int = 3) -> list[int]:
    """Votes that make a start of each template a candidate: ``votes``, or as many as the indexed words of its key phrase with the fewest."""
    return [max(1, min(votes, *(sum(w in index for w in p.split()) for p in t.phrases))) for t in templates]


def _literal(index: dict[str, list[tuple[int, int]]]) -> Column:
    posting = lambda t, p: F.struct(F.lit(t).alias("t"), F.lit(p).alias("p"))
    return F.create_map(*[x for w, at in index.items() for x in (F.lit(w), F.array(*[posting(t, p) for t, p in at]))])


def _candidates(words: Column, index: dict[str, list[tuple[int, int]]], votes: list[int]) -> Column:
    """Distinct (template, start) with at least as many postings as the template's ``votes``: after sorting, the entry that many less one
    further on is the same."""
    if not index:
        return F.array().cast("array<struct<t:int,o:int>>")
    further = F.array(*[F.lit(v - 1) for v in votes])
    known = F.array(*map(F.lit, index))
    hits = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(known, w), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    starts = F.flatten(F.transform(hits, lambda h: F.transform(
        F.element_at(_literal(index), h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("o")))))
    return let(F.sort_array(starts), lambda s: F.array_distinct(F.filter(s, lambda x, k: F.get(s, k + F.get(further, x["t"])) == x)))


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase: each word of the text whose followers are the phrase's."""
    parts = phrase.split()
    def here(w, i):
        ok = w == parts[0]
        for k, part in enumerate(parts[1:], 1):
            ok = ok & (F.get(words, i + k) == part)
        return F.when(ok, i)
    return F.filter(F.transform(words, here), lambda x: x.isNotNull())


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, rare: int = 8, votes: int = 3, slack: int = 4) -> DataFrame:
    """All rows held in ``_row`` with n_words, n_base, first_word, last_word, base_labels, labels, score and ``found``.

    ``found`` holds every verified place: (label, start word, share of the template's words that stand where it has them).
    ``score`` is the largest share, or 1 where a base phrase stands; 0 without any. Texts are read whole. A null or empty text
    has no words, no labels and score 0; labels that a text earns twice are named once; every row is scanned by itself, so repeated rows
    give equal results and other columns of any name stay in ``_row``. No documents give no rows.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    index = rare_postings(*document_frequencies(docs, text, vocabulary), templates, rare)
    known = F.array(*map(F.lit, index)).cast("array<string>")
    lengths, tokens = [len(t.words) for t in templates], [F.array(*map(F.lit, t.words)) for t in templates]
    at = lambda column, t: F.element_at(F.array(*column), t + 1)
    joined = lambda x: F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" "))
    df = hold(docs, _source=F.col(text)).withColumn("_words", words_of(F.col("_source")))
    df = df.withColumns({"_known": F.arrays_overlap("_words", known), "_spaced": joined(F.col("_words"))})
    nowhere = F.array().cast("array<struct<start:int,label:string>>")
    labelled = lambda label: lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))
    places = F.array_sort(F.flatten(F.array(*[
        F.when(F.contains("_spaced", F.lit(f" {p} ")), F.transform(_places(F.col("_words"), p), labelled(label))).otherwise(nowhere)
        for p, label in BASE.items()])))
    df = df.withColumns({"_base": places, "_starts": F.when(F.col("_known"), _candidates(F.col("_words"), index, needed_votes(index, templates, votes)))})

    def verified(c: Column) -> Column:
        window = joined(F.slice("_words", F.greatest(c["o"], F.lit(0)) + 1, at(map(F.lit, lengths), c["t"]) + slack))
        phrases = F.element_at(F.array(*[F.array(*map(F.lit, t.phrases)) for t in templates]), c["t"] + 1)
        return F.forall(phrases, lambda p: F.contains(window, F.concat(F.lit(" "), p, F.lit(" "))))

    def scored(c: Column) -> Column:
        words = F.element_at(F.array(*tokens), c["t"] + 1)
        hit = F.filter(words, lambda w, k: F.get("_words", c["o"] + k).eqNullSafe(w))
        return F.struct(F.element_at(F.array(*[F.lit(t.label) for t in templates]), c["t"] + 1).alias("label"),
                        F.greatest(c["o"], F.lit(0)).alias("start"), (F.size(hit) / F.size(words)).alias("share"))

    empty = F.array().cast("array<struct<label:string,start:int,share:double>>")
    df = df.withColumn("found", F.when(F.size("_starts") > 0, F.transform(F.filter("_starts", verified), scored)).otherwise(empty))
    base = F.transform("_base", lambda b: b["label"])
    listed = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return settle(df.select(
        "_row", F.size("_words").cast("long").alias("n_words"), F.size("_base").cast("long").alias("n_base"),
        F.element_at(F.when(F.size("_base") > 0, F.col("_base")), 1)["start"].cast("long").alias("first_word"),
        F.element_at(F.when(F.size("_base") > 0, F.col("_base")), -1)["start"].cast("long").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))).alias("score"),
        "found",
    ))
