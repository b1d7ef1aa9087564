"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams in rank order. A document's own
most frequent n-grams are compared with it: each adds how far its rank is out of place, or the
most that can be where the profile lacks it. The language with the least sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vasculum.llm.storage import in_parts, stored

#: N-grams of a language's profile, and of a document's.
PROFILE_GRAMS, DOCUMENT_GRAMS = 400, 300
#: About so many documents of each language are learned from, drawn by a hash of text; profiles hardly change beyond.
LEARN_DOCUMENTS = 2_000
UNKNOWN = "und"
#: A text is rejected below this share of the median score in the training fold, and never from MOST_NEEDED on. On sf0.1 medians are 0.76 to 0.81, clean
#: held-out documents score 0.51 or more, those of a language left out of learning 0.25 to 0.31 in the median, 0.46 at the 99th percentile.
NEEDED, MOST_NEEDED = 0.6, 0.45
#: Texts of fewer distinct n-grams (a word or two) say less, so they need less: random words and real ones overlap there.
SHORT_GRAMS, SHORT_NEEDED = 40, 0.4
#: Steps of the histogram of scores that finds the median.
SCORE_STEPS = 10_000
PART_CHARS = 1_000_000


@cache
def _letters() -> np.ndarray:
    """Code point to the code point of its lower-case letter; 32 where it is no letter."""
    table = np.full(0x110000, 32, np.uint64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def text_grams(text: str) -> np.ndarray:
    """The 1- to 3-grams of a text's words, each as an integer of 21 bits a letter; words have a space at each end. Empty without letters."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]])
    codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
    if len(codes) < 3:
        return np.zeros(0, np.uint64)
    pairs = codes[:-1] << np.uint64(21) | codes[1:]
    return np.concatenate([codes[codes != 32], pairs, (pairs[:-1] << np.uint64(21) | codes[2:])[codes[1:-1] != 32]])


def _ranked(text: str) -> np.ndarray:
    """A document's most frequent n-grams, most frequent first, ties by n-gram."""
    grams, counts = np.unique(text_grams(text), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:DOCUMENT_GRAMS]]


def _drawn(docs: DataFrame, may_learn: Column, text_col: str, lang_col: str, most: int) -> tuple[DataFrame | None, list[str]]:
    """(lang, text) of about `most` distinct texts of each language, drawn by their hash, one row each; and the languages. None if there are no rows."""
    rows = docs.filter(may_learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")
    )
    counts = {r["lang"]: r["count"] for r in rows.select("lang", "hash").distinct().groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return None, []
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, max(1, int(1e6 * most / n)))])
    rows = rows.filter(F.pmod("hash", F.lit(1_000_000)) < share[F.col("lang")])
    return rows.groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text"), list(counts)  # copies meet before the shuffle


def learn_profiles(docs: DataFrame, may_learn: Column, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Profile of each language, learned from the rows where `may_learn` holds and neither text nor language is null.

    About LEARN_DOCUMENTS distinct texts a language are drawn by their hash, and each is counted once however many rows hold it; n-grams are
    counted in the tasks, summed by Spark, and only the profiles come to the driver. Ties go by n-gram. No rows give no profiles.
    """
    rows, langs = _drawn(docs, may_learn, text_col, lang_col, LEARN_DOCUMENTS)
    if rows is None:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (rows for batch in batches for rows in in_parts(batch, 1, PART_CHARS)):
            langs = np.array(rows.column(0).to_pylist(), dtype=object)
            for lang in dict.fromkeys(langs):
                texts = rows.filter(pa.array(langs == lang)).column(1).to_pylist()
                grams, n = np.unique(np.concatenate([text_grams(t) for t in texts]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                )

    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    found = sums.withColumn("rank", rank).filter(F.col("rank") <= PROFILE_GRAMS).orderBy("lang", "rank").collect()
    profiles: dict[str, list[int]] = {lang: [] for lang in sorted(langs)}
    for r in found:
        profiles[r["lang"]].append(r["gram"])
    return profiles


class Identifier:
    """Compares documents with profiles."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, np.array(profiles[lang], np.uint64)), k] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and score. The score is the share of the greatest distance that is saved; 0 for an unknown language. Ties go to the first name."""
        grams = _ranked(text) if text else ()
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), max(len(self.grams) - 1, 0))
        at = np.where(self.grams[at] == grams, at, len(self.grams)) if len(self.grams) else np.zeros(len(grams), np.int64)
        ranks = self.ranks[at]
        distance = np.where(ranks < 0, PROFILE_GRAMS, np.abs(ranks - np.arange(len(grams))[:, None])).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(max(0.0, 1 - distance[best] / (PROFILE_GRAMS * len(grams))))


def learn_medians(docs: DataFrame, may_learn: Column, profiles: dict[str, list[int]], text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Median score of each language over all distinct texts that `may_learn` allows and that are found to be in their language.

    A median, so that junk among the texts moves it little; a language of which no text is found has none. It is exact: a histogram tells in which
    of SCORE_STEPS steps the middle lies, and only the scores of that step are ordered.
    """
    if not profiles:
        return {}
    rows = docs.filter(may_learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")
    )
    # Copies meet by their hash, so no text is shuffled.
    found = identify(rows, profiles).filter("lang_pred = lang").groupBy("lang", "hash").agg(F.min("score").alias("score"))
    scores = stored(found.select("lang", "score", F.floor(F.col("score") * SCORE_STEPS).alias("step")), "scores")
    counts: dict[str, list[tuple[int, int]]] = {}
    for r in scores.groupBy("lang", "step").count().collect():  # SCORE_STEPS + 1 rows a language at most
        counts.setdefault(r["lang"], []).append((r["step"], r["count"]))
    medians = {}
    for lang, steps in counts.items():
        steps.sort()
        total, before, wanted = sum(n for _, n in steps), 0, []
        middle = {(total - 1) // 2, total // 2}
        for step, n in steps:
            wanted += [(step, place - before) for place in sorted(middle) if before <= place < before + n]
            before += n
        values = []
        for step, place in wanted:
            near = scores.filter((F.col("lang") == lang) & (F.col("step") == step)).groupBy("score").count()
            up_to = F.sum("count").over(Window.orderBy("score"))
            values.append(near.withColumn("up_to", up_to).filter(F.col("up_to") > place).agg(F.min("score")).first()[0])
        medians[lang] = sum(values) / len(values)
    return medians


def least_score(median: float, grams: int) -> float:
    """The score that a text of so many distinct n-grams needs in a language of this median."""
    return min(MOST_NEEDED, NEEDED * median) if grams >= SHORT_GRAMS else min(MOST_NEEDED, NEEDED * median) * SHORT_NEEDED / NEEDED


def identify(
    docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", only_known: bool = False, medians: dict[str, float] | None = None
) -> DataFrame:
    """The rows with lang_pred and score; with `only_known`, the unchanged rows whose language is known and, given `medians`, whose score is at
    least least_score of the language found.

    A text without letters, empty or null, is `und` with score 0, and so is every text if there are no profiles. Whole texts are
    read. Equal texts get equal results. Columns lang_pred and score that `docs` has already are replaced.
    """
    docs = docs if only_known else docs.drop("lang_pred", "score")
    at = docs.columns.index(text_col)
    model = docs.sparkSession.sparkContext.broadcast(profiles)  # languages x PROFILE_GRAMS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(model.value)
        for batch in batches:
            for rows in in_parts(batch, at, PART_CHARS):
                found = [identifier(t) for t in rows.column(at).to_pylist()]
                if only_known:
                    texts = rows.column(at).to_pylist() if medians else []
                    keep = [lang != UNKNOWN for lang, _ in found]
                    for k, (text, (lang, score)) in enumerate(zip(texts, found, strict=False)):
                        if keep[k] and score < MOST_NEEDED and score < least_score(medians.get(lang, 0.0), len(_ranked(text))):
                            keep[k] = False
                    yield rows.filter(pa.array(keep, pa.bool_()))
                else:
                    extra = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
                    yield pa.RecordBatch.from_arrays([*rows.columns, *extra], [*rows.schema.names, "lang_pred", "score"])

    if only_known:
        return docs.mapInArrow(run, docs.schema)
    return docs.mapInArrow(run, docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema)
