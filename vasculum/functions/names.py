"""People: first collector, standard form `Surname, INITIALS [particle]`, parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vasculum.functions.nulls import bind, blank_to_null

# Text removed from, and marks that separate people in, a collector cell.
NOISE_BEFORE = ["Collector(s):", "Unknown"]
NOISE_AFTER = ["et al.", "et al", "etal"]
PEOPLE_SEPARATORS = ["&", " y ", " and "]
JUNIOR, JUNIOR_MARK = "Jr.", "JUNIOR"

# Letters of the name grammar (Latin-1 accents allowed).
CAPITAL = "[A-ZÀ-Ÿ]"
SMALL = "[a-zà-ÿ]"
SURNAME = f"({CAPITAL}{SMALL}+)"
INITIAL = f"({CAPITAL})"
GIVEN = f"({CAPITAL}){SMALL}+"
PARTICLE = f"({SMALL}{{0,3}})"


def _optional(pattern: str, times: int) -> str:
    return f"(?:{pattern})?" * times


# Each rule reads a whole name; groups that do not take part come out empty, so one
# rule serves one to four initials, with or without a particle.
_SURNAME_COMMA = [
    (rf"{SURNAME},\W+{GIVEN}\s+{GIVEN}" + _optional(rf"\s+{GIVEN}", 2) + _optional(rf"\s+{PARTICLE}", 1),
     "$1, $2$3$4$5 $6"),
    (rf"{SURNAME},\W+{INITIAL}{SMALL}{{2,20}}" + _optional(rf"\s+{PARTICLE}", 1), "$1, $2 $3"),
    (rf"{SURNAME},\W+{INITIAL}\W+{INITIAL}\W+{INITIAL}" + _optional(rf"\W+{INITIAL}", 1)
     + r"\W*" + _optional(rf"\s+{PARTICLE}", 1),
     "$1, $2$3$4$5 $6"),
    (rf"{SURNAME},\W+{INITIAL}\W+{INITIAL}\W+{INITIAL}\W" + _optional(rf"\s+{PARTICLE}", 1) + r",.+",
     "$1, $2$3$4 $5"),
    (rf"{SURNAME},\W+{INITIAL}" + _optional(rf"\W+{INITIAL}", 1) + r"\W+" + _optional(rf"\s+{PARTICLE}", 1),
     "$1, $2$3 $4"),
]
_SURNAME_INITIALS = [
    (rf"{SURNAME}\W+{INITIAL}" + f"{INITIAL}?" * 3 + _optional(rf"\s+{PARTICLE}", 1), "$1, $2$3$4$5 $6"),
    (rf"{SURNAME}\W*", "$1"),
]
_GIVEN_SURNAME = [
    (GIVEN + _optional(rf"\s{GIVEN}", 3) + _optional(rf"\s{PARTICLE}", 1) + rf"\s{SURNAME}", "$6, $1$2$3$4 $5"),
    (rf"{GIVEN}\s{INITIAL}\W+" + _optional(rf"{PARTICLE}\s", 1) + SURNAME, "$4, $1$2 $3"),
]
_INITIALS_SURNAME = [
    (rf"{INITIAL}\W+" + _optional(rf"{INITIAL}\W+", 3) + _optional(rf"{PARTICLE}\s", 1) + SURNAME,
     "$6, $1$2$3$4 $5"),
    (f"{INITIAL}{INITIAL}" + f"{INITIAL}?" * 2 + r"\W+" + _optional(rf"{PARTICLE}\s", 1) + SURNAME,
     "$6, $1$2$3$4 $5"),
]


def first_collector(c: Column, junior: str = JUNIOR_MARK) -> Column:
    """The first person of a collector cell, without boilerplate."""
    for text in NOISE_BEFORE:
        c = F.replace(c, F.lit(text), F.lit(""))
    for text in PEOPLE_SEPARATORS:
        c = F.replace(c, F.lit(text), F.lit(";"))
    c = F.replace(c, F.lit(JUNIOR), F.lit(junior))
    for text in NOISE_AFTER:
        c = F.replace(c, F.lit(text), F.lit(""))
    return blank_to_null(F.split_part(c, F.lit(";"), F.lit(1)))


def standardise_name(c: Column) -> Column:
    """`Surname, INITIALS [particle]`; null for a name that fits no known form."""

    def read(name: Column, rules) -> Column:
        return F.coalesce(
            *[
                F.when(
                    name.rlike(rf"(?U)^{rule}\z"),
                    F.trim(F.regexp_replace(name, rf"(?U)^{rule}\z", out)),
                )
                for rule, out in rules
            ]
        )

    def standard(name: Column) -> Column:
        # The head of the name decides which few rules can apply at all.
        return (
            F.when(name.rlike(f"^{CAPITAL}{SMALL}+,"), read(name, _SURNAME_COMMA + _SURNAME_INITIALS))
            .when(name.rlike(f"^{CAPITAL}{SMALL}"), read(name, _SURNAME_INITIALS + _GIVEN_SURNAME))
            .otherwise(read(name, _INITIALS_SURNAME))
        )

    return bind(c, standard)


def surname(c: Column) -> Column:
    return F.split_part(c, F.lit(","), F.lit(1))


def given_names(c: Column) -> Column:
    """What follows the surname, or null."""
    return blank_to_null(F.try_element_at(F.split(c, ", ", 2), F.lit(2)))


def initials(c: Column) -> Column:
    """Capital initials of a standard name, particle left out."""
    return F.trim(F.regexp_replace(F.coalesce(given_names(c), F.lit("")), "[a-z]", ""))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """Similarity by insertions and deletions only, 2·LCS/(|a|+|b|), from 0 to 100; null if a side is null.

    The longest common subsequence is a fold over the characters of one side, which carries the
    row of lengths over the other side. For pairs that survive blocking: work grows with |a|·|b|.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    left, right = (F.filter(F.split(x, ""), lambda c: c != "") for x in (a, b))

    def next_row(row: Column, letter: Column) -> Column:
        # row[j]: common length with the first j + 1 letters of the right side.
        def step(done: Column, j: Column) -> Column:
            diagonal = F.coalesce(F.get(row, j - 1), F.lit(0)) + 1
            kept = F.greatest(F.get(row, j), F.coalesce(F.get(done, j - 1), F.lit(0)))
            return F.concat(done, F.array(F.when(F.get(right, j) == letter, diagonal).otherwise(kept)))

        return F.aggregate(F.sequence(F.lit(0), F.size(row) - 1), F.array().cast("array<int>"), step)

    start = F.transform(right, lambda _: F.lit(0))
    common = F.when(F.size(right) > 0, F.coalesce(F.element_at(F.aggregate(left, start, next_row), -1), F.lit(0))).otherwise(0)
    size = F.length(a) + F.length(b)
    return F.when(size == 0, F.lit(100.0)).otherwise(200.0 * common / size)
