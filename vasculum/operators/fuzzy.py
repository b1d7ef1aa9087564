"""Fuzzy name matching against a reference list, without comparing all pairs.

The most similar surname is searched best first, by falling levels of similarity. Two words that are that similar have many
letters in common, so they share one of their rarest letters: only words that do are compared, after bounds by length and by
letters in common. A word whose best match reaches the level is done, whatever else there is; only the others go on to the next level.

With a limit, two words within edit distance k share a word that is left after at most k deletions
from each. So both sides are expanded to those remainders and joined on them: every
pair within distance k meets, and no other pair of note does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.names import given_names, indel_ratio, levenshtein_similarity, surname
from vasculum.operators.groups import materialise


def remainders(word: Column, distance: int) -> Column:
    """The word and everything left of it after up to `distance` deletions."""
    words = F.array(word)
    for _ in range(distance):
        cut = F.transform(
            words,
            lambda w: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))),
                lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))),
            ),
        )
        words = F.array_distinct(F.concat(words, F.flatten(cut)))
    return words


def prepare_reference(names: DataFrame, column: str) -> DataFrame:
    """Full name, surname and first names of a reference list."""
    return (
        names.select(F.col(column).alias("full_name"))
        .distinct()
        .withColumns(
            {
                "ref_surname": surname(F.col("full_name")),
                "ref_given": F.coalesce(given_names(F.col("full_name")), F.lit("0")),
            }
        )
    )


def near_surnames(asked: DataFrame, reference: DataFrame, distance: int) -> DataFrame:
    """For each distinct surname the nearest reference surname within `distance`."""
    left = asked.select("surname").distinct().withColumn("_r", F.explode(remainders(F.col("surname"), distance)))
    right = reference.select("ref_surname").distinct().withColumn(
        "_r", F.explode(remainders(F.col("ref_surname"), distance))
    )
    similar = levenshtein_similarity(F.col("surname"), F.col("ref_surname"))
    return (
        left.join(right, "_r")
        .filter(F.levenshtein("surname", "ref_surname") <= distance)
        .groupBy("surname")
        .agg(F.min_by("ref_surname", F.struct(-similar, F.col("ref_surname"))).alias("ref_surname"))
    )


def numbered_letters(word: Column) -> Column:
    """The letters of a word, each with its occurrence: what two words have in common of these bounds their common subsequence."""
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    return F.transform(letters, lambda c, i: F.concat(c, F.size(F.filter(F.slice(letters, F.lit(1), i + 1), lambda x: x == c)).cast("string")))


def _rarest_first(words: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (word, n, letters): a word's numbered letters, those that fewest reference words have first."""
    letters = words.withColumn("letter", F.explode_outer(numbered_letters(F.col("word")))).join(counts, "letter", "left")
    ranked = F.sort_array(F.collect_list(F.when(F.col("letter").isNotNull(), F.struct(F.coalesce("n_words", F.lit(0)).alias("n"), "letter"))))
    return letters.groupBy("word").agg(ranked.alias("letters")).select("word", F.size("letters").alias("n"), F.col("letters.letter").alias("letters"))


def _level(asked: DataFrame, reference: DataFrame, tenths: int) -> DataFrame:
    """The best reference word (word, ref_surname) of each asked word that has one of at least this similarity, in tenths."""

    def prefixed(side: DataFrame, mark: str) -> DataFrame:
        # Of n letters, any partner this similar shares as many as this; so one of the first n - least + 1 at least.
        least = F.greatest(F.ceil(F.col("n") * tenths / (20 - tenths) - 1e-9), F.lit(1)).cast("int")
        first = F.slice("letters", F.lit(1), F.greatest(F.col("n") - least + 1, F.lit(0)))
        return side.select(F.col("word").alias(mark), F.col("n").alias("n" + mark), F.col("letters").alias("l" + mark), first.alias("f" + mark)).withColumn(
            "letter", F.explode("f" + mark)
        )

    pairs = prefixed(asked, "a").join(prefixed(reference, "b"), "letter")
    pairs = pairs.filter(20 * F.least("na", "nb") >= tenths * (F.col("na") + F.col("nb")))
    pairs = pairs.filter(F.element_at(F.array_intersect("fa", "fb"), 1) == F.col("letter"))  # a pair meets at the first letter that both share
    pairs = pairs.filter(20 * F.size(F.array_intersect("la", "lb")) >= tenths * (F.col("na") + F.col("nb")))
    ratio = pairs.select("a", "b", indel_ratio("a", "b").alias("ratio")).filter(F.col("ratio") >= 10 * tenths - 1e-9)
    return ratio.groupBy("a").agg(F.min_by("b", F.struct(-F.col("ratio"), F.col("b"))).alias("ref_surname")).withColumnRenamed("a", "word")


def nearest_surnames(asked: DataFrame, reference: DataFrame) -> DataFrame:
    """For each distinct surname the reference surname of the highest similarity (2 x common subsequence / both lengths), whatever it is;
    equal ones go by name. A surname that shares no letter with any gets the first name of the list."""
    refs = reference.select(F.col("ref_surname").alias("word")).filter("word is not null").distinct()
    counts = refs.select(F.explode(numbered_letters(F.col("word"))).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n_words"))
    refs = materialise(_rarest_first(refs, counts))
    open_ = materialise(_rarest_first(asked.select(F.col("surname").alias("word")).filter("word is not null").distinct(), counts))
    found = []
    for tenths in range(9, 0, -1):
        done = materialise(_level(open_, refs, tenths))
        found.append(done)
        open_ = materialise(open_.join(done.select("word"), "word", "left_anti"))
        if open_.isEmpty():
            break
    # What is left is hardly like anything: every shared letter counts.
    first = refs.agg(F.min("word")).first()[0]
    rest = open_.join(_any_letter(open_, refs), "word", "left")
    found.append(rest.select("word", F.coalesce("ref_surname", F.lit(first)).alias("ref_surname")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("word", "surname")


def _any_letter(asked: DataFrame, reference: DataFrame) -> DataFrame:
    """The best reference word of each asked word that shares a letter with any."""
    left = asked.select(F.col("word").alias("a"), F.explode("letters").alias("letter"))
    right = reference.select(F.col("word").alias("b"), F.explode("letters").alias("letter"))
    pairs = left.join(right, "letter").select("a", "b").distinct()
    ratio = pairs.withColumn("ratio", indel_ratio("a", "b"))
    return ratio.groupBy("a").agg(F.min_by("b", F.struct(-F.col("ratio"), F.col("b"))).alias("ref_surname")).withColumnRenamed("a", "word")


def best_names(df: DataFrame, column: str, reference: DataFrame, distance: int | None = None) -> DataFrame:
    """The best reference name for each distinct name: most similar surname, among those the
    most similar first names, with a check whether the first initials agree.
    With a `distance`, surnames are compared by edits and those further than it from all others have no match.
    `reference` comes from `prepare_reference`."""
    # Written once: names are often dear to compute (regular expressions over all rows), and are read several times from here.
    names = materialise(df.select(F.col(column).alias("name")).distinct())
    asked = names.filter("name is not null").withColumns(
        {
            "surname": surname(F.col("name")),
            "given": F.coalesce(given_names(F.col("name")), F.lit(" ")),
        }
    )
    nearest = nearest_surnames(asked, reference) if distance is None else near_surnames(asked, reference, distance)
    score = levenshtein_similarity(F.col("given"), F.col("ref_given"))
    pairs = asked.join(nearest, "surname").join(reference, "ref_surname").withColumn("score", score)
    best = pairs.groupBy("name").agg(
        F.min_by(
            F.struct("full_name", "ref_given", "given", "score"), F.struct(-F.col("score"), "full_name")
        ).alias("_best")
    )
    agrees = F.substring("_best.given", 1, 1) == F.substring("_best.ref_given", 1, 1)
    return asked.select("name").join(best, "name", "left").select(
        "name",
        F.col("_best.full_name").alias("best_name"),
        F.round("_best.score", 6).alias("score"),
        agrees.alias("initial_agrees"),
    )
