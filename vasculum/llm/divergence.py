"""Quality rules by distribution divergence, with DataFrame functions alone.

Each document's histograms of character classes and of common words are compared with those of the languages, gathered
over all documents, by Jensen-Shannon distance; short documents are not judged by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vasculum.llm.storage import stored

#: Character classes, in the order in which they are taken out of a text; what is left is the last class (fixed values).
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "space": " \t\n\x0b\f\r",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "symbol": "#*$%&|<>",
    "stop": ".,;:!?'",
    "digit": "0123456789",
    "mark": "\"()[]{}/\\-_+=@^~`",
}
#: Common words of languages (fixed values); other languages are compared by what they have of these.
COMMON = (
    "the of and to in is that it for on with as was by are this from be "
    "der die und das den von zu mit sich dem nicht ein eine im auf "
    "de la le et les des en un une du que est dans qui pour par "
    "el los que y se del las por con una su para es al lo"
)
WORDS = sorted(set(COMMON.split()))
WINDOW = 5


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Number of words inside windows that occur twice or more, from the windows' hashes in text order."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    bound = F.transform(F.array(placed), lambda s: F.filter(  # a one-element array binds the sorted array once
        s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
    ))
    places = F.array_sort(F.transform(F.get(bound, F.lit(0)), lambda x: x["i"]))
    spans = F.transform(F.array(places), lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b
    ))
    return F.coalesce(F.get(spans, F.lit(0)), F.lit(0)).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (doc_id, lang, n_words, n_chars, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes, common): counts over each whole text."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = rows.select(
        "*", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"), F.col("text").alias("left0")
    )
    for k, chars in enumerate(CLASSES.values()):  # each step works on what the one before left
        rows = rows.select("*", F.translate(f"left{k}", chars, "").alias(f"left{k + 1}")).withColumn(
            f"n{k}", F.length(f"left{k}") - F.length(f"left{k + 1}")
        )
        rows = rows.drop(f"left{k}")
    names = list(CLASSES)
    rows = rows.withColumn(
        "classes", F.array(*[F.col(f"n{k}").cast("long") for k in range(len(names))], F.length(f"left{len(names)}").cast("long"))
    ).withColumn("size", F.length("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(
        F.size("words") > WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("words") - WINDOW + 1), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    )
    rows = rows.select(
        "doc_id", "lang", "words", "classes", F.col("size").cast("long").alias("n_chars"), lines.alias("lines"), windows.alias("windows"),
        (F.col("size") - F.col(f"n{names.index('space')}")).cast("long").alias("word_chars"),
        F.col(f"n{names.index('symbol')}").cast("long").alias("n_symbols"),
    )
    hits = F.filter(F.transform("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda w: w.isin(WORDS))
    rows = rows.select(
        "*", hits.alias("hits"), F.coalesce(F.size(F.array_distinct("windows")) < F.size("windows"), F.lit(False)).alias("repeats")
    )
    common = F.transform(F.array(*map(F.lit, WORDS)), lambda c: F.size(F.filter("hits", lambda w: w == c)).cast("long"))
    return rows.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        "n_chars", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("repeats"), _repeated_words(F.col("words"), F.col("windows"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        "classes",
        F.concat(common, F.array((F.size("words") - F.size("hits")).cast("long"))).alias("common"),
    )


def _references(found: DataFrame, least_words: int) -> list[tuple[list[float], list[float]]]:
    """Histograms of each language with at least `least_words` words: one row a language comes to the driver."""
    n = (len(CLASSES) + 1, len(WORDS) + 1)
    sums = [F.sum(F.col("classes")[k]).alias(f"a{k}") for k in range(n[0])] + [F.sum(F.col("common")[k]).alias(f"b{k}") for k in range(n[1])]
    rows = found.filter("lang is not null").groupBy("lang").agg(F.sum("n_words").alias("words"), *sums).orderBy("lang").collect()
    out = []
    for r in rows:
        if r["words"] >= least_words:
            a, b = [r[f"a{k}"] for k in range(n[0])], [r[f"b{k}"] for k in range(n[1])]
            out.append(([x / max(sum(a), 1) for x in a], [x / max(sum(b), 1) for x in b]))
    return out


def _distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, so 0 to 1) of a histogram with a positive total to a reference."""

    def part(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)

    parts = F.zip_with(F.transform(counts, lambda x: x / total), F.array(*map(F.lit, reference)), part)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    least_words: int = 30, most_class_distance: float = 0.3, most_word_distance: float = 0.6, reference_words: int = 1_000,
) -> DataFrame:
    """Rows (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance).

    Distances are those to the nearest language reference, and null where there is none: for documents of fewer than `least_words` words, which the
    distances do not judge, and if no language has `reference_words` words. A null text has no words and so fails the base rule. Rows without
    language are judged but teach nothing. Repeated rows are judged alike; other columns are ignored; no rows give no rows.
    """
    found = stored(features(docs, id_col, text_col, lang_col), "features")
    references = _references(found, reference_words)
    long_enough = F.col("n_words") >= least_words
    none = F.lit(None).cast("double")
    pairs = [F.struct((a + b).alias("sum"), a.alias("a"), b.alias("b")) for a, b in
             ((_distance(F.col("classes"), F.col("n_chars"), x), _distance(F.col("common"), F.col("n_words"), y)) for x, y in references)]
    nearest = F.when(long_enough, F.array_min(F.array(*pairs))) if pairs else F.struct(none.alias("sum"), none.alias("a"), none.alias("b"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = found.withColumn("nearest", nearest).withColumn("base_failed", failed)
    within = (F.col("nearest.a") <= most_class_distance) & (F.col("nearest.b") <= most_word_distance)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"),
        F.col("nearest.a").alias("class_distance"), F.col("nearest.b").alias("word_distance"),
    )
