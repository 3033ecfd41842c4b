"""Licence scan by a positional rare-token index, in DataFrame functions only.

The index is over licence templates, fixed and small: each template is a word
sequence, a word's IDF is taken over the templates, and a template's postings
are the relative positions of its ``RARE`` rarest words. For a file the words
of highest IDF are looked up: one pass over its words keeps the positions of
those that the index lists. A template's candidate places are the
intersection of the postings, each shifted by its relative position; they
count only if the mandatory key phrase stands there, word for word.

Base phrases are templates that consist of their key phrase alone, so every
place of theirs is found. Longer templates add labels of their own when their
key phrase stands at a candidate place; their score is the IDF share of the
template's words found at their positions.

Defined results: null and empty texts have no words, no places, null first and
last word, empty labels and score 0.0; repeated rows give equal rows; an empty
table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.operators.base import with_columns_once

RARE = 3

#: Separators of words, as a Java pattern.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]         # the mandatory phrase: from, to
    base: bool = False


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    w, k = tuple(text.split()), tuple((key or text).split())
    at = next(i for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k)
    return Template(label, w, (at, at + len(k)), base)


BASE = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
)

#: Usual licence notices: label, notice, its mandatory phrase.
NOTICES = (
    template("mit", "released under the mit license", "the mit license"),
    template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    template("gpl-3", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    template("gpl-2", "this work is licensed under the gnu general public license version 2",
             "gnu general public license version 2"),
    template("lgpl-3", "gnu lesser general public license version 3", "lesser general public license"),
    template("agpl-3", "gnu affero general public license version 3", "affero general public license"),
    template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    template("cc-by", "licensed under cc by 4 0", "cc by 4"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify and or distribute this software"),
)


class Index:
    """IDF of template words and each template's rarest words with their positions."""

    def __init__(self, templates: tuple[Template, ...], rare: int = RARE):
        n = len(templates)
        df: dict[str, int] = {}
        for t in templates:
            for w in set(t.words):
                df[w] = df.get(w, 0) + 1
        self.idf = {w: math.log((n + 1) / (c + 0.5)) for w, c in df.items()}
        self.templates = templates
        # Rarest words of the mandatory phrase: only they must stand.
        self.postings = [sorted(sorted(range(*t.key), key=lambda i, t=t: (-self.idf[t.words[i]], i))[:rare])
                         for t in templates]
        self.rare = sorted({t.words[i] for t, at in zip(templates, self.postings) for i in at})


def text_words(text: Column) -> Column:
    """Words of a text, A-Z as a-z. Only ASCII is compared later, so other letters
    may be lower-cased too; the Kelvin sign alone would become ASCII."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.filter(F.split(low, SEPARATOR, -1), lambda w: w != "")


def scan(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and places: for each template an array of the starts of its key phrase
    (column ``t<number>``), and ``s<number>``: the best share of its IDF found at such a place."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_words(F.col(text)).alias("w"))
    rows = with_columns_once(rows.select("doc_id", F.col("w").alias("_w")), w=F.col("_w")).drop("_w")
    listed = F.transform("w", lambda x, i: F.struct(x.alias("w"), i.alias("i")))
    rows = with_columns_once(rows, hits=F.filter(listed, lambda x: x["w"].isin(*index.rare)))

    def places(t: Template, rare: list[int]) -> Column:
        def at(i: int) -> Column:
            mine = F.filter("hits", lambda h: h["w"] == t.words[i])
            return F.transform(mine, lambda h: h["i"] - F.lit(i))
        found = at(rare[0])
        for i in rare[1:]:
            found = F.array_intersect(found, at(i))
        lo, hi = t.key
        phrase = F.array(*[F.lit(x) for x in t.words[lo:hi]])
        there = F.filter(found, lambda p: (p + lo >= 0) & (F.slice("w", F.greatest(p + lo + 1, F.lit(1)), F.lit(hi - lo)) == phrase))
        return F.when(F.size("hits") >= len(rare), F.transform(there, lambda p: p + lo))

    def share(n: int, t: Template) -> Column:
        whole = sum(index.idf[x] for x in t.words)
        lo = t.key[0]

        def of(p: Column) -> Column:
            total = F.lit(0.0)
            for i, x in enumerate(t.words):
                spot = p - lo + i
                total = total + F.when((spot >= 0) & (F.get("w", spot) == x), F.lit(index.idf[x])).otherwise(F.lit(0.0))
            return F.least(total / F.lit(whole), F.lit(1.0))
        return F.coalesce(F.array_max(F.transform(f"t{n}", of)), F.lit(0.0))

    names = {f"t{n}": F.coalesce(places(t, rare), F.array().cast("array<int>"))
             for n, (t, rare) in enumerate(zip(index.templates, index.postings))}
    rows = with_columns_once(rows, **names)
    return rows.select("doc_id", F.size("w").cast("long").alias("n_words"), *names,
                       *[share(n, t).alias(f"s{n}") for n, t in enumerate(index.templates)])


def op2(docs: DataFrame, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    index = Index(BASE + tuple(notices))
    found = scan(docs, index)
    base = [n for n, t in enumerate(index.templates) if t.base]
    places = F.concat(*[F.col(f"t{n}") for n in base])

    def labels(numbers) -> Column:
        names = F.array(*[F.when(F.size(f"t{n}") > 0, F.lit(index.templates[n].label)) for n in numbers])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")

    every = range(len(index.templates))
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(every).alias("labels"),
        F.greatest(*[F.col(f"s{n}") for n in every]).alias("score"))
