"""License scans by an exact set-similarity join, with DataFrame functions alone.

Template and block tokens are ordered by their frequency over all documents, rarest first. A block can contain enough of a template
only if it shares a token of the template's prefix, is long enough, and has enough tokens left after the first shared one; the blocks
that pass are compared exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: License notices and their labels (fixed values).
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
#: Words of a window for each word of its template.
WIDTH = 2
#: Between words, once A-Z are lower case; WORD also takes A-Z, for texts as they are.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), GAP), lambda w: w != "")


def _has_word(text: Column, words: list[str]) -> Column:
    """Whether one of the words may stand in the text; a quick test that never misses one."""
    return text.rlike("(?i)" + "|".join(sorted(words)))


def token_order(docs: DataFrame, templates: list[tuple[str, str]], text_col: str = "text") -> list[str]:
    """The templates' tokens, rarest over all documents first, ties by token. As many rows as the templates have tokens come to the driver."""
    vocabulary = sorted({w for text, _ in templates for w in text.split()})
    words = docs.select(F.explode(F.filter(F.split(F.col(text_col), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: F.length(w) <= max(map(len, vocabulary)))).alias("w"))
    counts = words.select(F.lower("w").alias("w")).filter(F.col("w").isin(vocabulary)).groupBy("w").count().collect()
    found = {r["w"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _places(words: Column, phrase: list[str]) -> Column:
    """Starts of the phrase in an array of words."""
    steps = F.sequence(F.lit(0), F.greatest(F.size(words) - len(phrase), F.lit(0)))

    def here(i: Column) -> Column:
        same = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            same = same & (F.get(words, i + k) == word)
        return F.coalesce(same, F.lit(False))

    return F.filter(steps, here)


def _matches(block: Column, order: list[str], templates: list[tuple[str, str]], threshold: float) -> Column:
    """(label, containment) of the templates that a block, an array of words, contains: prefix, length and positional filters, then the exact share."""
    rank = {w: k for k, w in enumerate(order)}

    def match(own: Column) -> Column:
        found = []
        for text, label in templates:
            tokens = sorted(set(text.split()), key=rank.__getitem__)
            need = math.ceil(threshold * len(tokens) - 1e-9)
            prefix = tokens[: len(tokens) - need + 1]
            first = F.coalesce(*[F.when(F.array_contains(own, w), F.lit(k)) for k, w in enumerate(prefix)])
            token = F.get(F.array(*map(F.lit, prefix)), first)
            fits = (F.size(own) >= need) & first.isNotNull()
            fits = fits & (F.least(F.lit(len(tokens)) - first, F.size(own) - F.array_position(own, token) + 1) >= need)
            share = F.size(F.array_intersect(own, F.array(*map(F.lit, tokens)))) / len(tokens)
            found.append(F.when(fits & (share >= threshold - 1e-9), F.struct(F.lit(label).alias("label"), share.alias("share"))))
        return F.array_compact(F.array(*found))

    mine = F.filter(F.array(*map(F.lit, order)), lambda w: F.array_contains(block, w))  # in the global order; other words match nothing
    return F.flatten(F.transform(F.array(mine), match))


def _window_matches(words: Column, order: list[str], templates: list[tuple[str, str]], threshold: float) -> Column:
    """(label, containment) of the templates that a window of a text's words contains, by the same filters as for a line.

    A window has WIDTH times as many words as the template, and one begins at every word, so line breaks do not matter. A window with enough of a
    template holds a word of its prefix: only windows that reach one are compared, each for the first that it reaches.
    """
    rank = {w: k for k, w in enumerate(order)}

    def one(words: Column, own: Column, hits: Column, text: str, label: str) -> Column:
        """Array of the template's match, empty without one. What is used twice is bound by a lambda, or it would be worked out twice."""
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        prefix, everything = F.array(*map(F.lit, tokens[: len(tokens) - need + 1])), F.array(*map(F.lit, tokens))
        width = WIDTH * len(text.split())

        def best(near: Column) -> Column:
            def from_hit(i: Column, k: Column) -> Column:
                start = F.greatest(i - (width - 1), F.coalesce(F.get(near, k - 1) + 1, F.lit(0)), F.lit(0))
                return F.array_max(F.transform(F.sequence(start, i), lambda s: F.size(F.array_intersect(F.slice(words, s + 1, width), everything))))

            return F.array_max(F.transform(near, from_hit))

        near = F.filter(hits, lambda i: F.array_contains(prefix, F.get(words, i)))
        most = F.filter(F.transform(F.array(near), best), lambda n: n >= need)
        found = F.transform(most, lambda n: F.struct(F.lit(label).alias("label"), (n / len(tokens)).alias("share")))
        return F.when(F.size(F.array_intersect(own, everything)) >= need, found).otherwise(F.array().cast("array<struct<label:string,share:double>>"))

    def match(both: Column) -> Column:
        return F.flatten(F.array(*[one(both["words"], both["own"], both["hits"], *t) for t in templates]))

    prefixes = set()
    for text, _ in templates:
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        prefixes.update(tokens[: len(tokens) - math.ceil(threshold * len(tokens) - 1e-9) + 1])
    listed = F.array(*map(F.lit, sorted(prefixes)))
    hits = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(listed, w), i)), lambda i: i.isNotNull())
    both = F.struct(words.alias("words"), F.array_intersect(words, F.array(*map(F.lit, order))).alias("own"), hits.alias("hits"))
    return F.flatten(F.transform(F.array(both), match))


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    windows: bool = False,
) -> DataFrame:
    """Rows (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each document.

    A block is a line or, with `windows`, a window of WIDTH times the template's number of words at any place of the whole text, so that notices that are
    wrapped over lines are found and words scattered over a long line are not. It matches a template if it has a share of at least `threshold` of the
    template's distinct words. score is the greatest such share, 1
    if a base phrase occurs, else 0. A null or empty text has no words, no labels (empty strings) and score 0. Repeated rows are judged alike; other
    columns are ignored; no rows give no rows.
    """
    order = token_order(docs, templates, text_col)
    rank = {w: k for k, w in enumerate(order)}
    prefixes = set()
    for text, _ in templates:
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        prefixes.update(tokens[: len(tokens) - math.ceil(threshold * len(tokens) - 1e-9) + 1])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = _has_word(F.col("text"), ["license", "cc"])
    rows = rows.select("*", F.when(base, _words(F.col("text"))).alias("words"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"))
    rows = rows.select("*", *[F.when(F.col("words").isNotNull(), _places(F.col("words"), p.split())).alias(f"p{k}") for k, p in enumerate(PHRASES)])
    none = F.array().cast("array<int>")
    places = F.concat(*[F.coalesce(f"p{k}", none) for k in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(F.coalesce(f"p{k}", none)) > 0, F.lit(v)) for k, v in enumerate(PHRASES.values())]))
    rows = rows.select("*", places.alias("places"), labels.alias("base"))
    if windows:
        edge = "[0-9A-Za-z\\x80-\\x{10FFFF}]"
        may = F.col("text").rlike(f"(?i)(?<!{edge})(?:{'|'.join(sorted(prefixes))})(?!{edge})")
        rows = rows.withColumn("words", F.when(may, F.coalesce("words", _words(F.col("text")))))
        rows = rows.withColumn("found", F.when(F.col("words").isNotNull(), _window_matches(F.col("words"), order, templates, threshold)))
        rows = rows.withColumn("found", F.coalesce("found", F.array().cast("array<struct<label:string,share:double>>")))
    else:
        blocks = F.filter(F.split("text", "\n"), lambda x: _has_word(x, list(prefixes)))
        rows = rows.withColumn("tokens", F.transform(blocks, _words))
        rows = rows.withColumn("found", F.flatten(F.transform("tokens", lambda b: _matches(b, order, templates, threshold))))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("found", lambda x: x["label"])))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
