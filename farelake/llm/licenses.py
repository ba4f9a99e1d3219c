"""Operator 4: licence scans with a positional rare-token index.

Licence templates are short word sequences with a label and a mandatory key
phrase. The index maps template words to their places (template, position).
Document frequencies of the template words are counted over the whole corpus;
a template is indexed by its words in at most ``RARE_SHARE`` of the documents
and, however common they are, by the ``MIN_AGREE`` highest-IDF words of its key
phrase. All occurrences of indexed words in a file are looked up and turned
into relative positions (place in the file minus place in the template). A
template counts when its key phrase stands at a relative position; the anchors
of the phrase then agree on it, so no other template or word of the file and no
common word can hide it. Its coverage is the IDF weight of the indexed words that
agree over that of all its indexed words, so verbatim text has 1. Three base phrases are also searched directly.

Two scans and one aggregate over at most the template vocabulary; texts are
never shuffled. Only built-in functions run.

Defined cases: a null or empty text has no words, no labels and score 0;
equal IDFs are ordered by the word; a word of every document weighs
``LEAST_IDF``; a repeated row counts in the document frequencies like any
other; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import ascii_lower, bind, documents, occurrences, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, template words, mandatory key phrase inside the template)
TEMPLATES = [
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("reserved", "all rights reserved", "all rights reserved"),
]

RARE_SHARE = 0.25
MIN_AGREE = 2
LEAST_IDF = 0.01


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of digits, a-z and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for _, body, _ in templates for w in body.split()})


def inverse_frequencies(df: DataFrame, text: str = "text", templates=TEMPLATES) -> dict[str, float]:
    """IDF of every template word over all rows of ``df``.

    The driver receives one count per template word, whatever the corpus size.
    """
    vocab = vocabulary(templates)
    listed = F.array(*[F.lit(w) for w in vocab])
    seen = df.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(listed, words_of(text_of(text))))).alias("w"))
    counts = {r["w"]: r["n"] for r in seen.groupBy("w").agg(F.count("*").alias("n")).collect()}
    rows = counts.get("", 0)
    return {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for w in vocab}


def indexed_words(idf: dict[str, float], templates=TEMPLATES) -> list[dict[str, float]]:
    """Per template its indexed words and their weights."""
    ceiling = math.log(1.0 / RARE_SHARE)
    found = []
    for _, body, phrase in templates:
        anchors = sorted(set(phrase.split()), key=lambda w: (-idf[w], w))[:MIN_AGREE]
        words = {w for w in body.split() if idf[w] >= ceiling}.union(anchors)
        found.append({w: max(idf[w], LEAST_IDF) for w in sorted(words)})
    return found


def _postings(templates, index: list[dict[str, float]]) -> Column:
    """Literal map: indexed word → its places (template, position)."""
    places: dict[str, list] = {}
    for t, (_, body, _) in enumerate(templates):
        for p, word in enumerate(body.split()):
            if word in index[t]:
                places.setdefault(word, []).append({"t": t, "p": p})
    return F.from_json(F.lit(json.dumps(places)), "map<string,array<struct<t:int,p:int>>>")


def _checks(templates, index: list[dict[str, float]]) -> Column:
    """Literal array: per template its phrase and its indexed words, highest IDF first, by position."""
    checks = []
    for t, (_, body, phrase) in enumerate(templates):
        ws, key = body.split(), phrase.split()
        shift = next(i for i in range(len(ws)) if ws[i : i + len(key)] == key)
        words = [
            {"w": w, "idf": idf, "at": [p for p, other in enumerate(ws) if other == w]}
            for w, idf in sorted(index[t].items(), key=lambda e: (-e[1], e[0]))
        ]
        checks.append({
            "t": t, "shift": shift, "total": sum(index[t].values()), "words": words,
            "phrase": [{"p": shift + k, "w": w} for k, w in enumerate(key)],
        })
    return F.from_json(
        F.lit(json.dumps(checks)),
        "array<struct<t:int,shift:int,total:double,words:array<struct<w:string,idf:double,at:array<int>>>,"
        "phrase:array<struct<p:int,w:string>>>>",
    )


def scan_licenses(
    df: DataFrame,
    idf: dict[str, float],
    key: str = "doc_id",
    text: str = "text",
    templates=TEMPLATES,
    base=BASE,
) -> DataFrame:
    """``(doc_id, n_words, places, matches)`` for every row.

    ``places``: base hits ``(at, label)``; ``matches``: verified templates
    ``(template, at, coverage)`` with coverage = IDF weight of the agreeing words
    over the IDF weight of the template's indexed words.
    """
    index = indexed_words(idf, templates)
    names = sorted(set().union(*index))
    scanned = df.select(F.col(key).alias("doc_id"), words_of(text_of(text)).alias("words"))

    hits_type = "array<struct<at:int,places:array<struct<t:int,p:int>>>>"

    def lookup(ws: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(names))
        found = lambda x: F.transform(
            x["spots"],
            lambda i: F.struct(i.alias("at"), F.element_at(x["index"], F.get(ws, i)).alias("places")),
        )
        return bind(
            spots,
            lambda s: F.when(
                F.size(s) > 0,
                bind(F.struct(s.alias("spots"), _postings(templates, index).alias("index")), found),
            ).otherwise(F.array().cast(hits_type)),
        )

    hits = F.when(F.size("words") > 0, bind(F.col("words"), lookup)).otherwise(
        F.array().cast(hits_type)
    )

    places = F.when(
        F.array_contains("words", "license"),
        F.concat(*[_labelled(phrase, label) for phrase, label in base.items()]),
    ).otherwise(F.array().cast("array<struct<at:int,label:string>>"))

    staged = scanned.select("doc_id", "words", places.alias("places"), hits.alias("hits"))
    value = F.struct(F.col("words").alias("words"), F.col("hits").alias("hits"), _checks(templates, index).alias("checks"))
    found = bind(value, lambda x: F.flatten(F.transform(x["checks"], lambda c: _template_matches(x, c))))
    empty = "array<struct<template:int,at:int,coverage:double>>"
    return staged.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "places",
        F.when(F.size("hits") > 0, found.cast(empty)).otherwise(F.array().cast(empty)).alias("matches"),
    )


def _labelled(phrase: str, label: str) -> Column:
    return F.transform(
        occurrences(F.col("words"), phrase.split()),
        lambda at: F.struct(at.alias("at"), F.lit(label).alias("label")),
    )


def _template_matches(x: Column, check: Column) -> Column:
    """Relative positions at which the template of ``check`` is verified, with coverage."""
    ws, hits = x["words"], x["hits"]

    def holds(at: Column, word: Column) -> Column:
        # outside the text there is no word
        return F.coalesce(F.get(ws, at) == word, F.lit(False))

    def weigh(o: Column) -> Column:
        agreeing = F.filter(check["words"], lambda w: F.exists(w["at"], lambda p: holds(o + p, w["w"])))
        weight = F.aggregate(agreeing, F.lit(0.0), lambda acc, a: acc + a["idf"])
        return F.struct(
            check["t"].alias("template"),
            (o + check["shift"]).alias("at"),
            F.least(weight / check["total"], F.lit(1.0)).alias("coverage"),
        )

    offsets = F.array_distinct(
        F.flatten(
            F.transform(
                hits,
                lambda h: F.transform(
                    F.filter(h["places"], lambda p: p["t"] == check["t"]), lambda p: h["at"] - p["p"]
                ),
            )
        )
    )
    standing = F.filter(offsets, lambda o: F.forall(check["phrase"], lambda q: holds(o + q["p"], q["w"])))
    return F.transform(standing, weigh)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places, all labels and the score of every document."""
    docs = documents(spark, sf_dir)
    scanned = scan_licenses(docs, inverse_frequencies(docs))
    labels = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])
    base = F.transform("places", lambda p: p["label"])
    added = F.transform("matches", lambda m: F.get(labels, m["template"]))
    starts = F.transform("places", lambda p: p["at"])
    best = F.array_max(F.transform("matches", lambda m: m["coverage"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, added))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.round(F.coalesce(best, F.lit(0.0)), 9))
        .alias("score"),
    )
