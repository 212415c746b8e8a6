"""License scans: a positional index of licence templates, looked up by each file's rare licence words.

All of it is DataFrame and SQL functions; there is no Python code on the executors.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import LOWER, UPPER, ascii_lower, bounded_batches

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Per cent of a template's weight that must stand at its places for the label of a notice.
MIN_PERCENT = 50


class Template(NamedTuple):
    """A licence text and the phrases of it that must be there, word for word, for its label."""

    label: str
    text: str
    keys: tuple[str, ...]


#: Openings of well-known licences and the notices that refer to them.
NOTICES = [
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("boost", "boost software license version 1 0", ("boost software license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
             "that the following conditions are met",
             ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("cc-attribution", "licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
             "hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("unencumbered software released into the public domain",)),
]


def phrase_templates(phrases: Sequence[tuple[str, str]]) -> list[Template]:
    """Base phrases (phrase, label) as templates that are one key phrase."""
    return [Template(label, phrase, (phrase,)) for phrase, label in phrases]


def template_words(template: Template) -> list[tuple[str, bool]]:
    """The template's words and whether each belongs to a key phrase (at every place where one stands)."""
    def split(text: str) -> list[str]:
        return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))

    words, marked = split(template.text), set()
    for key in map(split, template.keys):
        places = [k for k in range(len(words) - len(key) + 1) if words[k:k + len(key)] == key]
        if not key or not places:
            raise ValueError(f"a key phrase of {template.label} isn't in its text")
        marked.update(k + o for k in places for o in range(len(key)))
    return [(w, k in marked) for k, w in enumerate(words)]


def licence_weights(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """Weight of each licence word: 1 + round(1000 * ln((documents + 1) / (documents with the word + 1))).

    ``words`` has an array column ``words`` per document; all documents count. What comes back to the driver is one row
    per word of the templates at most.
    """
    seen = F.array_distinct(F.filter("words", lambda w: w.isin(list(vocabulary))))
    counts = dict(words.select(F.explode(F.array_append(seen, F.lit(""))).alias("word"))  # "" counts the documents
                  .groupBy("word").count().collect())
    total = counts.get("", 0) + 1
    return {w: 1 + round(1000 * math.log(total / (counts.get(w, 0) + 1))) for w in vocabulary}


def _sql(value) -> str:
    """A literal: numbers, strings without quotes, lists and dicts (structs)."""
    if isinstance(value, dict):
        return "named_struct(" + ", ".join(f"'{k}', {_sql(v)}" for k, v in value.items()) + ")"
    if isinstance(value, list):
        return "array(" + ", ".join(map(_sql, value)) + ")"
    return f"'{value}'" if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def positional_index(templates: Sequence[Template], weights: dict[str, int]) -> tuple[list[dict], list[dict]]:
    """Postings (word, t, at) and templates (words, weights, total, keys).

    A template is listed under the rarest word of its key phrases only (the smaller word of two that are as rare), once
    for each place where that word stands in a key phrase: a file that has the key phrases has this word at this place.
    """
    postings, bodies = [], []
    for t, template in enumerate(templates):
        words = template_words(template)
        anchor = min((-weights[w], w) for w, is_key in words if is_key)[1]
        postings += [{"word": w, "t": t, "at": k} for k, (w, is_key) in enumerate(words) if is_key and w == anchor]
        bodies.append({"words": [w for w, _ in words], "weights": [weights[w] for w, _ in words],
                       "total": sum(weights[w] for w, _ in words), "keys": [k for k, (_, is_key) in enumerate(words) if is_key]})
    return postings, bodies


def scan_licences(docs: DataFrame, phrases: Sequence[tuple[str, str]], notices: Sequence[Template] = NOTICES,
                  min_percent: int = MIN_PERCENT) -> DataFrame:
    """Finds licence phrases and notices in every whole text (doc_id, text; other columns are ignored).

    Words are ``WORD`` after lower-casing A-Z. A first pass counts in how many documents each licence word stands, which
    gives its weight (IDF). The second pass has no shuffle: in each text, the words that are the rarest one of a
    template's key phrases are looked up in the positional index; each posting gives a place where the template would
    start; the template's words are compared at their places from there, and the key phrases must be there in full. A
    phrase (phrase, label) counts at every such place. A notice gives its label if words of ``min_percent`` of its weight
    are at their places too.

    Returns one row per input row: doc_id, n_words, n_base, first_word, last_word (start of the first and last phrase,
    words from 0; null without any), base_labels, labels (arrays, sorted), score (largest share of a template's weight
    at its places, of all looked-up places; 0 without any). A null text is empty, a null doc_id stays null, repeated rows
    are judged each, and an empty table gives no rows. Two templates at one place count both.
    """
    bounded_batches(docs.sparkSession)
    templates = [*phrase_templates(phrases), *notices]
    vocabulary = sorted({w for t in templates for w, _ in template_words(t)})
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = docs.select("doc_id", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    postings, bodies = positional_index(templates, licence_weights(words, vocabulary))
    anchors = sorted({p["word"] for p in postings})

    # get() is null before and after the text. Arrays referred to in lambdas are columns of the step before.
    looked_up = words.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), F.expr(
        "filter(sequence(0, greatest(size(words) - 1, 0)), i -> get(words, i) IN "
        f"({', '.join(map(_sql, anchors))}))").alias("hits"))
    placed = looked_up.select("doc_id", "words", "n_words", F.expr(
        f"flatten(transform(hits, i -> transform(filter({_sql(postings)}, p -> p.word = get(words, i)), "
        "p -> named_struct('t', p.t, 'at', i - p.at))))").alias("places"))
    compared = placed.select("doc_id", "n_words", F.expr(
        f"""transform(transform(places, x -> named_struct('t', x.t, 'at', x.at, 'body', get({_sql(bodies)}, x.t))),
        x -> named_struct('t', x.t, 'at', x.at, 'total', x.body.total,
          'whole', forall(x.body.keys, k -> get(words, x.at + k) <=> get(x.body.words, k)),
          'found', aggregate(sequence(0, size(x.body.words) - 1), 0, (sum, k) -> sum + if(
            get(words, x.at + k) <=> get(x.body.words, k), get(x.body.weights, k), 0))))""").alias("places"))
    names = _sql([t.label for t in templates])
    judged = compared.select(
        "doc_id", "n_words", F.expr(f"filter(places, x -> x.whole AND x.t < {len(phrases)})").alias("base"),
        F.expr(f"filter(places, x -> x.whole AND x.t >= {len(phrases)} AND 100 * x.found >= {min_percent} * x.total)").alias("more"),
        F.expr("coalesce(array_max(transform(places, x -> x.found / x.total)), 0D)").alias("score"))
    return judged.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.expr("cast(array_min(transform(base, x -> x.at)) AS long)").alias("first_word"),
        F.expr("cast(array_max(transform(base, x -> x.at)) AS long)").alias("last_word"),
        F.expr(f"array_sort(array_distinct(transform(base, x -> get({names}, x.t))))").alias("base_labels"),
        F.expr(f"array_sort(array_distinct(transform(concat(base, more), x -> get({names}, x.t))))").alias("labels"),
        "score")
