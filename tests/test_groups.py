"""Hot groups, cut over many small tasks and batches, must give what large ones give, and what plain SQL gives."""

import random
from contextlib import contextmanager
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from vasculum.operators import rules as R
from vasculum.operators.dedup import dedup_master, dedup_raw
from vasculum.operators.filters import require
from vasculum.operators.groups import crossfill, is_duplicate, materialise, number_in_group, with_group_values
from vasculum.operators.merge import const, expert_first, first, join, join_or_null, last, mean, merge_group, newest_first, size, variance
from vasculum.operators.premerge import present, set_fingerprint
from vasculum.schema import NUMBERED_KEYS
from workload.view import ORDER, specimens

FOLDER = "/root/testdata/sf0.001"
SMALL = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "7", "spark.sql.shuffle.partitions": "13",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def small_pieces(spark):
    """Many tasks of few rows, in batches of seven rows, so that groups lie on several of them."""
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)

    def rows(df):
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.select(columns).dtypes]
        return sorted(map(str, df.select(*rounded).collect()))

    assert rows(a) == rows(b)


@pytest.fixture(scope="module")
def third_in_one(spark):
    """A third of the rows under one key, null parts included."""
    rng = random.Random(7)
    rows = [
        (i, None if rng.random() < 0.33 else f"k{rng.randrange(40)}", float(i % 9) if rng.random() < 0.4 else None, f"v{i % 13}")
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "id long, k string, x double, v string").repartition(5)


def both_ways(spark, make):
    usual = make().collect()
    with small_pieces(spark):
        spread = make().collect()
    assert sorted(map(str, usual)) == sorted(map(str, spread))
    return usual


def test_crossfill(spark, third_in_one):
    filled = both_ways(spark, lambda: crossfill(third_in_one, ["k"], ["x"], ["id"]))
    # Against brute force.
    rows = sorted(third_in_one.collect(), key=lambda r: r["id"])
    groups = {}
    for r in rows:
        groups.setdefault(r["k"], []).append(r)
    expected = {}
    for members in groups.values():
        for i, r in enumerate(members):
            before = [m["x"] for m in members[: i + 1] if m["x"] is not None]
            after = [m["x"] for m in members[i:] if m["x"] is not None]
            expected[r["id"]] = before[-1] if before else (after[0] if after else None)
    assert {r["id"]: r["x"] for r in filled} == expected


def test_number_in_group(spark, third_in_one):
    both_ways(spark, lambda: number_in_group(third_in_one, ["k"], ["id"], "n"))


def test_group_values_and_duplicates(spark, third_in_one):
    values = {"n": F.count(F.lit(1)), "first": F.min_by("v", "id"), "top": F.max("x")}
    both_ways(spark, lambda: with_group_values(third_in_one, ["k"], values))
    both_ways(spark, lambda: is_duplicate(third_in_one, ["k", "v"]))


def test_merge(spark):
    df = specimens(spark, FOLDER).withColumn("sufix", F.when(F.col("k_line") > 2, F.col("sufix")))
    order = [expert_first(), *newest_first(), *map(F.col, ORDER)]
    table = present(df, R.raw_merge(), ORDER)
    merged = both_ways(spark, lambda: merge_group(df, ["sufix", "country_iso3"], order, table))
    assert len(merged) == df.select("sufix", "country_iso3").distinct().count()


def test_cells_are_whole(spark):
    df = specimens(spark, FOLDER)
    order = [F.col(c) for c in ORDER]
    with small_pieces(spark):
        records = merge_group(df, ["source_id"], order, present(df, R.raw_merge(), ORDER))
    found = records.select(F.explode(F.split("barcode", ", ")).alias("barcode"))
    every = df.filter("barcode is not null").select(F.explode(F.split("barcode", ", ")).alias("barcode"))
    same(found, every)


def test_a_third_of_the_rows_under_one_key_equals_sql(spark, tmp_path):
    """300,000 rows: every kind of rule, an order of its own, and cells of 100,000 values."""
    rows = spark.range(300_000).select(
        "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 4_001)).alias("k"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), F.col("id") % 13)).alias("v"), F.concat(F.lit("w"), F.col("id") % 5).alias("w"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 100 / 7).alias("x"), ((F.col("id") * 7_919) % 300_007).alias("other"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    table = {
        "k": first(), "first": first("v"), "last": last("v"), "far": first("v", [F.col("other")]), "some": join(", ", "v"), "all": join_or_null(", ", "w"),
        "none": join_or_null(", ", "v"), "mean": mean("x"), "spread": variance("x"), "rows": size(), "fixed": const("c"),
    }
    got = merge_group(df.repartition(17), ["k"], [F.col("id")], table)
    got = {r.k: (r["first"], r["last"], r.far, r.some, r["all"], r.none, round(r.mean, 6), None if r.spread is None else round(r.spread, 6), r.rows, r.fixed) for r in got.collect()}
    want = duckdb.sql(f"""select k, first(v order by id) filter (where v is not null), last(v order by id) filter (where v is not null),
      first(v order by other) filter (where v is not null), string_agg(v, ', ' order by id), string_agg(w, ', ' order by id),
      case when count(v) = count(*) then string_agg(v, ', ' order by id) end, round(avg(x), 6), round(var_samp(x), 6), count(*), 'c'
      from read_parquet('{tmp_path}/rows/*.parquet') group by k""").fetchall()
    assert len(got) == len(want) and got[None][8] == 100_000
    for k, *values in want:
        assert list(got[k][:6]) == values[:6] and list(got[k][8:]) == values[8:]
        assert got[k][6] == pytest.approx(values[6], abs=2e-6) and got[k][7] == pytest.approx(values[7], abs=2e-6)


def test_merging_nothing(spark):
    df = spark.createDataFrame([], "id long, k string, v string")
    assert merge_group(df, ["k"], [F.col("id")], {"k": first(), "v": join(", ")}).count() == 0
    assert crossfill(df, ["k"], ["v"], ["id"]).count() == 0 and number_in_group(df, ["k"], ["id"], "n").count() == 0


def test_runs_over_many_tasks(spark):
    rows = [("a" if i < 390 else None, i if i < 400 else 10**12, i, "x" if i in (150, 300, 395) else None) for i in range(401)]
    df = spark.createDataFrame(rows, "k string, id long, n long, x string")
    with small_pieces(spark):
        numbered = {r["n"]: r["number"] for r in number_in_group(df, ["k"], ["id"], "number").collect()}
        filled = {r["n"]: r["x"] for r in crossfill(df, ["k"], ["x"], ["id"]).collect()}
    assert numbered == {i: i + 1 if i < 390 else i - 389 for i in range(401)}
    assert set(filled.values()) == {"x"}


def test_require_fails_under_count(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "p string, q string")
    assert require(df.filter("q is not null"), ["q"]).count() == 1
    with pytest.raises(Exception, match="lacks: q"):
        require(df, ["q"]).count()


@pytest.mark.parametrize("which", ["raw", "master", "expert"])
def test_dedup_hot(spark, which):
    df = specimens(spark, FOLDER).withColumn("colnum", F.when(F.col("k_line") != 1, F.col("colnum")))
    keys = ["country_iso3", "colnum", "col_year", "sufix"]

    def run():
        if which == "raw":
            return dedup_raw(df, keys, ORDER)
        return dedup_master(df, keys, ORDER, F.lit("s"), expert=which == "expert", unique_barcodes=True)

    usual = run()
    clean, bad = usual.clean, usual.quarantine
    with small_pieces(spark):
        spread = run()
        same(clean, spread.clean)
        same(bad, spread.quarantine)


def test_dedup_properties(spark):
    df = specimens(spark, FOLDER)
    out = dedup_raw(df, NUMBERED_KEYS, ORDER)
    clean = out.clean
    # No duplicate key is left, and input order does not matter.
    assert clean.groupBy(*NUMBERED_KEYS).count().filter("count > 1").count() == 0
    shuffled = df.orderBy(F.rand(3)).repartition(7)
    same(clean, dedup_raw(shuffled, NUMBERED_KEYS, ORDER).clean)
    # Every key is either merged or set aside.
    keys = df.select(*NUMBERED_KEYS).distinct().count()
    assert keys == clean.count() + out.quarantine.select(*NUMBERED_KEYS).distinct().count()


def test_raw_merge_fixture(spark):
    rows = [
        (1, "Doe, J", "12", None, 1998, "GAB", "K1", "Roe, A", 1999, "alba", 1.0, 10.0, "u1"),
        (2, "Doe, J", "12", None, 1998, "GAB", "P2", "Poe, B", 2010, "nigra", 1.2, 10.0, None),
    ]
    schema = (
        "record_id long, recorded_by string, colnum string, sufix string, col_year int, country_iso3 string, barcode string,"
        "det_by string, det_year int, specific_epithet string, ddlat double, ddlong double, link string"
    )

    def run(table):
        df = spark.createDataFrame(table, schema).withColumns(
            {c: F.lit(None).cast("string") for c in ("country", "locality", "prefix", "genus")}
        )
        return dedup_raw(df, NUMBERED_KEYS, ["record_id"])

    (row,) = run(rows).clean.collect()
    assert (row.specific_epithet, round(row.ddlat, 6), row.ddlong, row.link) == ("nigra", 1.1, 10.0, None)
    assert (row.det_by, row.barcode) == ("Poe, B / Roe, A", "P2, K1")
    far = [rows[0], rows[1][:10] + (3.0,) + rows[1][11:]]
    out = run(far)
    assert out.clean.count() == 0 and out.quarantine.count() == 2
    (filled,) = run([rows[0], rows[1][:10] + (None, None, None)]).clean.collect()
    assert filled.ddlat == 1.0


def test_fingerprints_tell_sets_apart(spark):
    sets = [["a"], ["b"], ["a", "b"], [], ["a", "c"], ["b", "c"], ["a", "b", "c"], [f"x{i}" for i in range(5_000)], [f"x{i}" for i in range(4_999)]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)] + [(100 + i, s[::-1]) for i, s in enumerate(sets)], "id int, codes array<string>")
    prints = {r.id: (r._set_size, r._set_a, r._set_b) for r in df.withColumns(set_fingerprint(F.col("codes"))).collect()}
    assert len(set(prints.values())) == len(sets) and all(prints[i] == prints[100 + i] for i in range(len(sets)))


def written(spark, make):
    """Rows out and bytes that came into the checkpoint folder."""
    def size():
        folder = spark.sparkContext.getCheckpointDir()
        return sum(f.stat().st_size for f in Path(folder.removeprefix("file:")).rglob("*") if f.is_file()) if folder else 0

    materialise(spark.range(1))  # sets the folder
    before = size()
    rows = make().count()
    return rows, size() - before


def test_rows_are_written_compressed(spark):
    """A wide table of few values takes little room, laid out by ranges or not."""
    df = spark.range(100_000).select(
        "id", (F.col("id") % 997).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("x"),
        *[F.concat(F.lit(f"a value of column {i}: "), ((F.col("id") * 7_919) % 101).cast("string")).alias(f"c{i}") for i in range(20)],
    )
    rows, size = written(spark, lambda: materialise(df))
    assert rows == 100_000 and size < 4_000_000
    rows, size = written(spark, lambda: crossfill(df, ["k"], ["x"], ["id"]))
    assert rows == 100_000 and size < 12_000_000
    order = [F.col("id")]
    table = {c: first() for c in df.columns} | {"c0": first(order=[F.col("x").isNull(), F.col("x"), F.col("id")])}
    rows, size = written(spark, lambda: merge_group(df, ["k"], order, table))
    assert rows == 997 and size < 6_000_000


def test_rows_with_columns_of_no_type_can_be_written(spark):
    df = spark.range(3).withColumn("nothing", F.lit(None))
    assert [tuple(r) for r in materialise(df).orderBy("id").collect()] == [(0, None), (1, None), (2, None)]


def test_keys_and_orders_that_are_no_plain_columns_of_the_rules(spark):
    """A key and an order that no rule takes, an order's term that is computed, and a source that is a key too."""
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 4, "y"), (None, 3, 1, "z"), (None, 4, 2, None)], "k string, id long, other long, v string")
    table = {"key": first("k"), "v": first(), "own": first("v", [-F.col("other"), F.col("id")]), "same": first("v", [F.col("other"), F.col("id")]), "n": size()}
    got = {r.key: tuple(r)[1:] for r in merge_group(df, ["k"], [-F.col("id")], table).collect()}
    assert got == {"a": ("y", "x", "y", 2), None: ("z", "z", "z", 2)}
