"""Fuzzy names against plain comparison of all pairs."""

import random

import pytest

from vasculum.operators.fuzzy import best_names, nearest_surnames, prepare_reference


def ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def names(spark, values, column="recorded_by"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def test_best_surname_whatever_its_distance(spark):
    reference = prepare_reference(names(spark, ["Cd, X", "Abcde, X", "Vanderbiltson, A"], "listed"), "listed")
    found = {r.name: r for r in best_names(names(spark, ["Ab, X", "Vanderbilt, A", "Zzz, Q", None]), "recorded_by", reference).collect()}
    assert {k: v.best_name for k, v in found.items()} == {"Ab, X": "Abcde, X", "Vanderbilt, A": "Vanderbiltson, A", "Zzz, Q": "Abcde, X"}
    assert found["Ab, X"].score == 1.0 and found["Zzz, Q"].initial_agrees is False
    near = {r.name: r.best_name for r in best_names(names(spark, ["Ab, X", "Vanderbilt, A"]), "recorded_by", reference, 2).collect()}
    assert near["Vanderbilt, A"] is None
    empty = prepare_reference(names(spark, [], "listed"), "listed")
    assert [r.best_name for r in best_names(names(spark, ["Ab, X"]), "recorded_by", empty).collect()] == [None]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aeiourstéß"])
def test_nearest_surnames_by_brute_force(spark, letters):
    rng = random.Random(len(letters))
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 13))) for _ in range(160)]
    asked, listed = words[:80] + ["qqq"], sorted(set(words[80:]))
    reference = prepare_reference(names(spark, [w + ", A" for w in listed], "listed"), "listed")
    found = {r.surname: r.ref_surname for r in nearest_surnames(names(spark, asked, "surname"), reference).collect()}
    assert found == {a: min(listed, key=lambda r: (-ratio(a, r), r)) for a in asked}
