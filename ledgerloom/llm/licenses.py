"""License scans: an exact set-similarity join of text blocks with license templates.

Both sides are sets of words.  A block meets a template when it holds at least ``THRESHOLD`` of the
template's words.  Words are put in one global order, by the number of documents that hold them,
rarest first.  Since a block may miss only few words of a template, it must hold one of the
template's first, rarest words (prefix filter), and it must be long enough (length filter).  There is
no positional filter: only the templates' words have places in the order, and by them a block that
holds any prefix word can still reach what it needs.  Blocks that pass are compared
word by word, so that none is missed.  The blocks of a text for a template are all windows of twice the
template's length, at every word; of those that hold the same of its words only the one that begins with
such a word is compared, as moving a block up to its first one loses none.

The templates are a short list of the library, so the join runs inside each row with DataFrame
functions only: no row is shuffled but the counts of the templates' own words.

Edge cases: null is the empty text, without words and labels; upper-case letters count as lower-case;
repeated rows and ties are scanned alike; any length is scanned whole; an empty table gives an empty
result (all words then count as equally rare).  Columns with the names of results give way to them.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.9

# Phrases whose words stand one after another, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notices of public licenses, with their labels.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache",
    "licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under cc by nc 4 0": "cc-by-nc",
}


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(rows: DataFrame, templates: dict[str, str]) -> dict[str, int]:
    """In how many documents each word of the templates occurs: as many numbers as the templates have words."""
    vocabulary = sorted({word for template in templates for word in template.split()})
    held = rows.select(F.explode(F.array_intersect("__words", _strings(vocabulary))).alias("word"))
    return dict.fromkeys(vocabulary, 0) | {word: n for word, n in held.groupBy("word").count().collect()}


def phrase_starts(phrase: str) -> Column:
    """Places of the row's words at which a phrase begins."""
    parts = phrase.split()

    def begins(place: Column) -> Column:
        return reduce(Column.__and__, [F.get("__words", place + k) == word for k, word in enumerate(parts)])

    there = F.array_contains("__words", parts[0]) & F.array_contains("__words", parts[-1])
    places = F.sequence(F.lit(0), F.greatest(F.size("__words") - len(parts), F.lit(0)))
    return F.when(there, F.filter(places, begins)).otherwise(F.array().cast("array<int>"))


def best_block(template: str, frequencies: dict[str, int], threshold: float) -> Column:
    """The largest share of a template's words that a block holds; 0 where no block can reach the threshold."""
    ordered = sorted(set(template.split()), key=lambda w: (frequencies[w], w))
    need = math.ceil(threshold * len(ordered))
    prefix = _strings(ordered[: len(ordered) - need + 1])
    length = 2 * len(template.split())
    size = F.size("__words")
    whole = _strings(ordered)
    places = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda p: F.array_contains(prefix, F.get("__words", p)))

    def starts(places: Column) -> Column:
        """Places of template words from which a block holds a prefix word; each place is met once."""

        def before(p: Column, k: Column) -> Column:
            free = F.coalesce(F.get(places, k - 1) + 1, F.lit(0))
            return F.filter(F.sequence(F.greatest(free, p - (length - 1)), p), lambda s: F.array_contains(whole, F.get("__words", s)))

        return F.flatten(F.transform(places, before))

    # In a list of one, the places are worked out once for all steps that look at them.
    blocks = F.flatten(F.transform(F.array(places), starts))
    long_enough = F.filter(blocks, lambda s: size - s >= need)

    def held(start: Column) -> Column:
        return F.size(F.array_intersect(F.slice("__words", start + 1, F.lit(length)), whole))

    most = F.coalesce(F.array_max(F.transform(long_enough, held)), F.lit(0))
    candidate = (size >= need) & F.arrays_overlap("__words", prefix)
    return F.when(candidate, F.when(most >= need, most / len(ordered)).otherwise(0.0)).otherwise(0.0)


def scan_licenses(
    docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows with ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the largest share of a template in a block that meets it; 1 with a base phrase.
    """
    templates = TEMPLATES if templates is None else templates
    if any(re.sub("[a-z0-9 ]", "", t) or not t.strip() for t in templates):
        raise ValueError("templates are lower-case words with blanks between them")
    rows = without(docs, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").withColumn("__words", words(F.col(text)))
    frequencies = document_frequencies(rows, templates)
    names = list(templates)
    found = rows.withColumns(
        {f"__p{k}": phrase_starts(p) for k, p in enumerate(PHRASES)}
        | {f"__t{k}": best_block(t, frequencies, threshold) for k, t in enumerate(names)}
    )
    starts = F.concat(*[F.col(f"__p{k}") for k in range(len(PHRASES))])
    base = [F.when(F.size(f"__p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]
    more = [F.when(F.col(f"__t{k}") > 0, F.lit(templates[t])) for k, t in enumerate(names)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    best = F.greatest(F.lit(0.0), F.lit(0.0), *[F.col(f"__t{k}") for k in range(len(names))])
    return (
        found.withColumn("__starts", starts)
        .withColumns({
            "n_words": F.size("__words").cast("long"),
            "n_base": F.size("__starts").cast("long"),
            "first_word": F.array_min("__starts").cast("long"),
            "last_word": F.array_max("__starts").cast("long"),
            "base_labels": joined(base),
            "labels": joined(base + more),
            "score": F.when(F.size("__starts") > 0, F.lit(1.0)).otherwise(best),
        })
        .drop("__words", "__starts", *[f"__p{k}" for k in range(len(PHRASES))], *[f"__t{k}" for k in range(len(names))])
    )
