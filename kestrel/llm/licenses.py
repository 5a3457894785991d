"""Operator 6: licence scans with a positional rare-token index.

Templates are word sequences with a label.  The index holds, for every
template, its rarest words (highest inverse document frequency over the whole
corpus) with their offsets.  A file looks up only these words; each hit votes
for the place where the template would begin (position minus offset), and places
on which all of a template's anchors agree are verified: a mandatory phrase must
stand word for word, the rest of the template counts towards the score.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import columns

_SQL_LOWER = "translate({}, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "')"
#: Share of a template's words that must stand at their offsets.
NEEDED = 0.8
#: Words are split before they are lower-cased, so A-Z belong to them here.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``words`` with the mandatory phrase at ``words[at:at + size]``, which must match exactly."""
    label: str
    words: tuple
    at: int
    size: int
    base: bool = False


def _template(label, text, phrase, base=False):
    words, key = tuple(text.split()), tuple(phrase.split())
    at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
    return Template(label, words, at, len(key), base)


#: The base phrases of the query, then licence notices with their mandatory phrases.
TEMPLATES = (
    _template("mit", "mit license", "mit license", base=True),
    _template("apache", "apache license", "apache license", base=True),
    _template("gpl", "general public license", "general public license", base=True),
    _template("agpl", "gnu affero general public license", "affero general public license"),
    _template("all-rights-reserved", "all rights reserved", "all rights reserved"),
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
              "redistribution and use in source and binary forms"),
    _template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    _template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    _template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    _template("gpl-3.0", "licensed under the gnu general public license version 3",
              "gnu general public license version 3"),
    _template("lgpl", "gnu lesser general public license", "lesser general public license"),
    _template("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software",
              "permission is hereby granted free of charge"),
    _template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
)


def ascii_lower(word: F.Column) -> F.Column:
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def licence_words(text: F.Column) -> F.Column:
    """The words of a text as written.  They are lower-cased only where they are compared:
    A-Z do not separate words, so that changes nothing but the work."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def document_frequency(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents with each word of ``vocabulary``, over all documents.

    One count per template word comes back to the driver: bounded by the templates."""
    # lower() finds a superset (it also maps a few letters beyond A-Z), ascii_lower decides.
    found = F.filter("_words", lambda w: F.lower(w).isin(vocabulary))
    rows = (docs.select(F.explode(F.array_distinct(F.transform(found, ascii_lower))).alias("w"))
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("w").isin(vocabulary)).collect())
    return {w: 0 for w in vocabulary} | {r["w"]: r["n"] for r in rows}


def build_index(templates, frequency: dict[str, int], anchors: int = 2) -> list[list[tuple[str, int, int]]]:
    """Postings (word, template, offset in the phrase) of each template's rarest words: one list
    per rank of rarity.  A phrase with fewer words repeats its last one."""
    index: list[list[tuple[str, int, int]]] = [[] for _ in range(anchors)]
    for n, t in enumerate(templates):
        rare = sorted(range(t.size), key=lambda i: (frequency[t.words[t.at + i]], i))
        for k in range(anchors):
            i = rare[min(k, t.size - 1)]
            index[k].append((t.words[t.at + i], n, i))
    return index


def _strings(items) -> str:
    """A SQL array of plain words (letters, digits, blanks and hyphens only)."""
    return "array(" + ", ".join(f"'{x}'" for x in items) + ")"


def scan(docs: DataFrame, templates=TEMPLATES, anchors: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and ``matches`` (label, start, share of the template's words found).

    Null and empty texts have no words and no labels; repeated rows give repeated
    results; extra columns are ignored; an empty table gives an empty result.
    """
    own = docs.select(*columns(docs, "doc_id", "text")).select("doc_id", licence_words(F.col("text")).alias("_words"))
    vocabulary = sorted({w for t in templates for w in t.words[t.at:t.at + t.size]})
    index = build_index(templates, document_frequency(own, vocabulary), anchors)
    rare = sorted({w for rank in index for w, _, _ in rank})
    n = len(templates)
    # Words of the file that are anchors, with their positions.
    at = F.when(F.size("_words") > 0, F.filter(
        F.sequence(F.lit(0), F.size("_words") - 1), lambda p: F.lower(F.get("_words", p)).isin(rare)))
    own = own.withColumn("_hits", F.coalesce(F.transform(at, lambda p: F.struct(
        ascii_lower(F.get("_words", p)).alias("w"), p.alias("p"))), F.array().cast("array<struct<w:string,p:int>>")))
    # Each rank's votes: place of the phrase times n plus the template's number.
    for k, rank in enumerate(index):
        postings = "array(" + ", ".join(f"struct('{w}' AS w, {t} AS t, {i} AS i)" for w, t, i in rank) + ")"
        own = own.withColumn(f"_votes{k}", F.expr(
            f"flatten(transform(_hits, x -> transform(filter({postings}, e -> e.w = x.w AND x.p >= e.i), "
            f"e -> CAST(x.p - e.i AS BIGINT) * {n} + e.t)))"))
    agreed = F.col("_votes0")
    for k in range(1, anchors):
        agreed = F.array_intersect(agreed, F.col(f"_votes{k}"))
    own = own.withColumn("_places", F.transform(F.array_distinct(agreed), lambda v: F.struct(
        F.floor(v / n).cast("int").alias("p"), F.pmod(v, F.lit(n)).cast("int").alias("t"))))
    phrases = _strings(" ".join(t.words[t.at:t.at + t.size]) for t in templates)
    sizes = "array(" + ", ".join(str(t.size) for t in templates) + ")"
    own = own.withColumn("_found", F.expr(
        f"filter(_places, x -> {_SQL_LOWER.format(f"array_join(slice(_words, x.p + 1, {sizes}[x.t]), ' ')")} = {phrases}[x.t])"))
    whole = "array(" + ", ".join(_strings(t.words) for t in templates) + ")"
    ats = "array(" + ", ".join(str(t.at) for t in templates) + ")"
    labels = _strings(t.label for t in templates)
    bases = "array(" + ", ".join(str(t.base).lower() for t in templates) + ")"
    own = own.withColumn("_all", F.expr(
        f"transform(_found, x -> struct({labels}[x.t] AS label, {bases}[x.t] AS base, x.p AS start, "
        f"size(filter(transform({whole}[x.t], (w, i) -> {_SQL_LOWER.format(f"get(_words, x.p - {ats}[x.t] + i)")} = w), ok -> ok)) "
        f"/ CAST(size({whole}[x.t]) AS DOUBLE) AS share))"))
    own = own.withColumn("matches", F.filter("_all", lambda m: m["base"] | (m["share"] >= F.lit(NEEDED))))
    own = own.withColumn("_base", F.filter("matches", lambda m: m["base"]))
    starts = F.transform("_base", lambda m: m["start"])

    def names(c):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"]))), ",")
    return own.select(
        "doc_id", F.size("_words").cast("bigint").alias("n_words"), F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        names("_base").alias("base_labels"), names("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"), "matches")


def licence_query(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("matches")
