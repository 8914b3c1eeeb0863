"""License scans by a positional rare-token index.

One pass over the texts writes, for each file, the number of its words, which
template words it holds, and the positions of these words if it holds a word
that some key phrase needs. From that table come the document frequencies of
the template words over all files, and the matches:

The index holds, for each word of the licence templates, its postings
(template, offset). A match must hold every word of its template's mandatory
key phrase, so the key phrase's words with the highest inverse document
frequency give candidates: each position says where the template would start.
The starts of the rarest word are intersected with those of the next rare
ones, until the whole key phrase stands; no start that the key phrase allows is
dropped, whichever other templates the file holds, and a template may start
before the file (a file that begins with its key phrase). The score of a match
is the share of the template's total word weight that stands at the right
places.

Base labels come from the same index: a phrase's places are where the
positions of all its words, shifted by their offsets, intersect.

Everything is a DataFrame expression over one row: no shuffle depends on a
source, key or text. Only the counts of the template words, a fixed list, come
to the driver.

Defined cases: null and empty texts have no words, no labels and score 0;
repeated rows get a row each; an empty table gives an empty result; other
columns never take part.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import table, text_of, written

# Base phrases, and templates with their mandatory key phrases (label, text, key phrase).
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
           ("mit license", "mit"))
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version", "gnu general public license"),
    ("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("proprietary", "all rights reserved", "all rights reserved"),
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Of the letters beyond ASCII, only the Kelvin sign has an ASCII lower case; any other letter takes its place.
_KELVIN, _OTHER = "\u212a", "\u0138"
_AT = "array<struct<i:bigint,w:string>>"


def vocabulary() -> list[str]:
    return sorted({w for _, t, k in TEMPLATES for w in (t + " " + k).split()}
                  | {w for p, _ in PHRASES for w in p.split()})


def _key_words() -> list[str]:
    """One word of every base phrase and key phrase, the one that fewest share: without any of them no match."""
    phrases = [p.split() for p, _ in PHRASES] + [k.split() for _, _, k in TEMPLATES]
    return sorted({max(p, key=lambda w: (len(w), w)) for p in phrases})


def _array(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def read_words(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id``, ``n_words``, ``present`` (template words of the file) and ``at`` (their positions; null
    for files without any key word) of every row."""
    low = F.lower(F.replace(text_of(text), F.lit(_KELVIN), F.lit(_OTHER)))
    vocab = vocabulary()
    rows = docs.select(F.col(ident).alias("_id"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("words"))
    at = F.filter(F.transform("words", lambda w, i: F.struct(i.cast("long").alias("i"), w.alias("w"))),
                  lambda p: p["w"].isin(vocab))
    return rows.select("_id", F.size("words").cast("long").alias("n_words"),
                       F.array_intersect("words", _array(vocab)).alias("present"),
                       F.when(F.arrays_overlap("words", _array(_key_words())), at).cast(_AT).alias("at"))


def document_frequencies(read: DataFrame) -> tuple[dict[str, int], int]:
    """Number of files that hold each template word, and number of files."""
    words = read.select(F.explode("present").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["w"]: r["n"] for r in words.collect()}  # at most one row per template word
    return {w: counts.get(w, 0) for w in vocabulary()}, read.count()


def _shifted(at: str, word: str, offset: int) -> Column:
    """Where a phrase would start that has this word at this offset; below 0 if before the file."""
    return F.transform(F.filter(at, lambda p: p["w"] == word), lambda p: p["i"] - offset)


def _places(phrase: list[str], idf: dict[str, float]) -> Column:
    """Starts of all places where the phrase's words stand consecutively, from its rarest word on."""
    rarest = sorted(enumerate(phrase), key=lambda x: (-idf[x[1]], x[0]))
    return reduce(F.array_intersect, [_shifted("at", w, o) for o, w in rarest])


def scan(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per file: ``n_words``, ``base`` (start, label), ``found`` (label, start, score)."""
    read = written(read_words(docs, ident, text), "licence-words")
    df, n = document_frequencies(read)
    idf = {w: math.log((1 + n) / (1 + c)) + 1e-6 for w, c in df.items()}
    rows = read.filter("at IS NOT NULL").select(
        "_id", "n_words", F.concat(*[_labelled(p.split(), label, idf) for p, label in PHRASES]).alias("base"),
        F.concat(*[_matches(label, t.split(), k.split(), idf) for label, t, k in TEMPLATES]).alias("found"))
    none = read.filter("at IS NULL").select("_id", "n_words", *[
        F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("base", "found")])
    return rows.unionByName(none)


def _labelled(phrase: list[str], label: str, idf: dict[str, float]) -> Column:
    return F.transform(_places(phrase, idf), lambda s: F.struct(s.alias("start"), F.lit(label).alias("label")))


def _matches(label: str, template: list[str], key: list[str], idf: dict[str, float]) -> Column:
    """Places of one template: label, start, score."""
    at_key = next(o for o in range(len(template)) if template[o:o + len(key)] == key)
    kept = F.transform(_places(key, idf), lambda s: s - at_key)
    total = sum(idf[w] for w in template)
    shares = [idf[w] / total for w in template]
    # a list of one struct, so that each word's places are computed once and not for every start
    there = F.array(F.struct(kept.alias("kept"), *[_shifted("at", w, o).alias(f"p{o}") for o, w in enumerate(template)]))

    def share(x: Column, s: Column) -> Column:
        parts = [F.when(F.array_contains(x[f"p{o}"], s), v).otherwise(0.0) for o, v in enumerate(shares)]
        return sum(parts[1:], parts[0])

    return F.flatten(F.transform(there, lambda x: F.transform(x["kept"], lambda s: F.struct(
        F.lit(label).alias("label"), s.alias("start"), share(x, s).alias("score")))))


def report(found: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Counts, labels and the best score of each file."""
    start = F.transform("base", lambda b: b["start"])
    base = F.transform("base", lambda b: b["label"])
    more = F.transform("found", lambda f: f["label"])

    def names(x: Column) -> Column:
        return F.coalesce(F.array_join(F.array_sort(F.array_distinct(x)), ","), F.lit(""))

    best = F.array_max(F.transform("found", lambda f: f["score"]))
    return found.select(
        F.col("_id").alias(ident), "n_words", F.coalesce(F.greatest(F.size("base"), F.lit(0)), F.lit(0))
        .cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        names(base).alias("base_labels"), names(F.concat(base, more)).alias("labels"),
        F.least(F.coalesce(best, F.lit(0.0)), F.lit(1.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(scan(table(spark, sf_dir, "documents")))
