"""What a run writes, counts and holds at once, on rows of the tests' own."""

import datetime
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vasculum.functions.nulls import normalise_nulls
from vasculum.operators import consolidate, dedup, experts, groups, merge
from vasculum.operators.authorities import resolve_collectors
from vasculum.operators.experts import integrate_expert_by_number, self_deduplicate
from vasculum.operators.fuzzy import best_names, prepare_reference
from vasculum.operators.merge import first, join, merge_group
from vasculum.operators.premerge import premerge
from vasculum.plans.finisher import finish
from vasculum.schema import NUMBERED_KEYS
from vasculum.sources.tables import Ledger
from workload import expert_queries, geo_queries, view


def tables_written(spark, make):
    """Rows out, and the tables that came into the checkpoint folder."""
    groups.materialise(spark.range(1))  # sets the folder
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("rows-*"))
    rows = make().collect()
    return rows, len(set(folder.glob("rows-*")) - before)


def test_rows_that_spark_leaves_out_are_counted(spark):
    """The job of rows that are filtered away as a whole has no count of its own."""
    ledger = Ledger()
    rows = ledger.before("split", spark.range(10))
    ledger.after("split", rows.filter(F.lit(False))).write.format("noop").mode("overwrite").save()
    other = ledger.before("empty", spark.range(1000).repartition(5, "id")).join(spark.range(10).filter("id % 7 > 100").repartition(4, "id"), "id")
    ledger.after("empty", other).write.format("noop").mode("overwrite").save()
    assert ledger.counts() == [("split", 10, 0, False), ("empty", 1000, 0, False)]


def test_large_tables_are_joined_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    day = datetime.date(1998, 5, 3)
    tables = {
        "nation": ([(1, "GABON")], "n_nationkey int, n_name string"),
        "customer": ([(1, 1, "Doe, J"), (2, 1, "Roe, A")], "c_custkey long, c_nationkey int, c_name string"),
        "supplier": ([(3, "Poe, B"), (4, "Doe, K")], "s_suppkey long, s_name string"),
        "part": ([(5, "annona alba", "alba", "Brand#1")], "p_partkey long, p_name string, p_type string, p_brand string"),
        "orders": ([(i, 1 + i % 2, day, "F") for i in range(30)], "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string"),
        "lineitem": (
            [(i % 30, i // 30, 5, 3 + i % 2, 1.5, day, "ANR"[i % 3], "F", 0.0, 0.0) for i in range(90)] + [(None, 1, 5, 3, 1.5, day, "A", "F", 0.0, 0.0)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate date, l_returnflag string,"
            " l_linestatus string, l_tax double, l_discount double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    small = view.specimens(spark, str(tmp_path))
    monkeypatch.setattr(view, "JOINED_ROWS", 2)
    large = view.specimens(spark, str(tmp_path))
    assert large.count() == 90 and large.exceptAll(small).count() == 0 and small.exceptAll(large).count() == 0
    assert large.select("k_order").rdd.getNumPartitions() == 45  # 91 rows; more than the session's 4


def test_batches_of_long_cells_are_merged_in_pieces(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(["x" * 1_000_000] * 100)], ["id", "cell"])
    pieces = list(groups.in_pieces(batch))
    assert sum(p.num_rows for p in pieces) == 100 and max(p.nbytes for p in pieces) < 1.2 * groups.PACKED_BYTES
    df = spark.range(60).select("id", (F.col("id") % 2).alias("k"), F.concat(F.col("id").cast("string"), F.expr("repeat('x', 1000000)")).alias("cell"))
    cells = {r.k: r.cell for r in merge_group(df, ["k"], [F.col("id")], {"k": first(), "cell": join(", ")}).collect()}
    assert cells == {k: ", ".join(f"{i}{'x' * 1_000_000}" for i in range(k, 60, 2)) for k in (0, 1)}


SCHEMA = "record_id long, recorded_by string, prefix string, colnum string, sufix string, det_by string, det_year int, accepted_name string, expert_det string, modified string"


def test_expert_by_number_writes_rows_once(spark):
    """Records that meet none stay as they were, those that meet merge, and rows are written before and after the merge only."""
    rows = [
        (1, "Doe, J", None, "1", None, "a", 2000, "old", "EXP", "m1"), (2, "Doe, J", None, "2", None, "b", 2001, "kept", "EXP", "m2"),
        (3, "Doe, J", None, "2", "A", "c", None, None, None, None), (4, "Poe, B", None, "1", None, "d", 2002, "far", None, "m4"),
        (5, "Doe, J", None, None, None, "e", 2003, "bare", None, "m5"),
    ]
    master = spark.createDataFrame(rows, SCHEMA)
    expert = spark.createDataFrame([(10, "Doe, J", None, "1", None, "x", 2020, "new", None), (11, "Doe, J", None, "7", None, "x", 2020, "own", None)], SCHEMA.rsplit(",", 1)[0])
    out, tables = tables_written(spark, lambda: integrate_expert_by_number(master, expert, ["record_id"]))
    got = {r.record_id: (r.accepted_name, r.expert_det, r.modified, r.det_year) for r in out}
    assert len(out) == 6 and got == {
        10: ("new", "SMALLEXP", None, 2020), 2: ("kept", "EXP", "m2", 2001), 3: (None, None, None, None), 4: ("far", None, "m4", 2002),
        5: ("bare", None, "m5", 2003), 11: ("own", None, None, 2020),
    }
    assert tables == 2


def test_premerge_does_not_write_merged_rows_anew(spark):
    schema = "record_id long, barcode string, status string, det_year int, expert_det string, accepted_name string"
    master = spark.createDataFrame([(1, "K1", None, 2000, None, "a"), (2, "K2", None, None, None, "b"), (3, None, None, None, None, "c")], schema)
    new = spark.createDataFrame([(4, "K1, K2, K1", None, 2001, None, "d"), (5, "K3", None, None, None, "e")], schema)
    out, tables = tables_written(spark, lambda: premerge(master, new, ["record_id"]))
    assert sorted((r.barcode, r.accepted_name) for r in out) == [("K1, K2", "d"), ("K3", "e")]
    assert tables == 3


def counted(spark, column):
    """A copy of a text column, and the number of rows for which it has been computed."""
    done = spark.sparkContext.accumulator(0)

    def copy(text):
        done.add(1)
        return text

    return F.udf(copy, "string")(column), done


def test_names_are_computed_once(spark):
    """Collectors' names are regular expressions over all rows: a search for their best names reads them once, not for each join."""
    name, done = counted(spark, F.concat(F.lit("Doe"), F.col("id") % 5, F.lit(", A")))
    reference = prepare_reference(spark.createDataFrame([("Doe1, A",), ("Roe, B",)], "listed string"), "listed")
    found = best_names(spark.range(100).select(name.alias("who")), "who", reference, 2).collect()
    assert len(found) == 5 and {r.best_name for r in found} == {"Doe1, A"}
    assert done.value == 100


def test_collectors_are_computed_once(spark):
    name, done = counted(spark, F.concat(F.element_at(F.array(*map(F.lit, ("Doe", "Roe", "Poe", "Moe", "Coe"))), (F.col("id") % 5 + 1).cast("int")), F.lit(", A")))
    rows = spark.range(100).select("id", name.alias("recorded_by"), F.lit("Doe, A").alias("orig_recby"), F.lit(1900).alias("col_year"))
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("huh_name", "geo_col", "wiki_url")})
    people = spark.createDataFrame([(1, "Roe, Ann", 1850, None, "Gabon", None)], "link_id long, name string, dobirth int, dodeath int, geo_col string, wiki_url string")
    resolved = resolve_collectors(rows, people, ["id"]).collect()
    assert len(resolved) == 100 and sum(r.huh_name == "Roe, Ann" for r in resolved) == 20
    assert done.value == 100


def test_records_are_computed_once_for_merge_and_rest(spark):
    """Records that can be merged and those that cannot come from rows that are written once."""
    code, done = counted(spark, F.concat(F.lit("K"), F.col("id")))
    columns = "genus specific_epithet sufix prefix det_by country locality institute herbarium_code orig_bc orig_recby link status accepted_name"
    rows = spark.range(40).select(
        F.col("id").alias("k_order"), F.lit("Doe, J").alias("recorded_by"), F.when(F.col("id") < 30, (F.col("id") % 10).cast("string")).alias("colnum"),
        code.alias("barcode"), F.lit(1900).alias("det_year"), F.lit(None).cast("string").alias("expert_det"), F.lit("x").alias("source_id"),
        *[F.lit(None).cast("string").alias(c) for c in columns.split()],
    )
    assert self_deduplicate(rows, ["k_order"]).count() == 20
    assert done.value == 40
    done.value = 0
    finished = finish(rows, ["k_order"])
    assert finished.clean.count() == 20 and finished.to_check.count() == 0
    assert done.value == 40


def test_code_for_missing_values_is_small(spark):
    """Java does not compile methods of over 8,000 bytes; the missing values of a table of 40 columns stay below."""
    texts = spark.range(8).selectExpr(*[f"array('', '-9999', ' nan ', 'x', '<NA>', null, 'a,b', ',')[id] as c{i}" for i in range(25)], "id")
    rows = groups.materialise(texts)
    fixed = normalise_nulls(rows)
    assert [r.c3 for r in fixed.orderBy("id").collect()] == [None, None, None, "x", None, None, "a,b", ","]
    told = spark._jvm.PythonSQLUtils.explainString(fixed._jdf.queryExecution(), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", told))) < 8000


def test_rows_and_shuffles_of_a_step_are_removed(spark):
    """What a merge or scan has written for its layout goes when its result is written; the session's settings stay."""
    groups.materialise(spark.range(1))  # sets the folder
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows, before, was = spark.range(100).selectExpr("id % 7 as k", "id", "cast(null as string) as x"), set(folder.glob("rows-*")), spark.conf.get(setting)
    merged = merge_group(rows, ["k"], [F.col("id")], {"k": first(), "id": first()})
    filled = groups.crossfill(rows, ["k"], ["x"], ["id"])
    assert sum(any(f.suffix == ".parquet" for f in made.iterdir()) for made in set(folder.glob("rows-*")) - before) == 1  # the merged rows
    assert sorted(r.id for r in merged.collect()) == list(range(7)) and filled.count() == 100 and spark.conf.get(setting) == was


def test_only_keys_of_many_rows_are_laid_out_by_ranges(spark):
    """Finding ranges reads whole rows once more, so rows are dealt by the key's hash; a key of too many rows still goes over tasks, in order."""
    small_tasks = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(small_tasks)
    spark.conf.set(small_tasks, "false")
    try:
        layouts(spark)
    finally:
        spark.conf.set(small_tasks, was)


def layouts(spark):
    rows = spark.range(100_000).select("id", (F.col("id") % 5_000).alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    laid, path, short = groups.in_runs(rows, ["k"], ["id"])
    plan = spark._jvm.PythonSQLUtils.explainString(laid._jdf.queryExecution(), "formatted")
    assert "hashpartitioning(k" in plan and "rangepartitioning" not in plan and short
    assert laid.count() == 100_000 and laid.select("k", F.spark_partition_id()).distinct().count() == 5_000
    groups.remove_rows(spark, path)

    skewed = rows.withColumn("k", F.when(F.col("id") % 3 > 0, F.col("k")))
    laid, path, _ = groups.in_runs(skewed, ["k"], ["id"])
    placed = [(r.k, r.id, r.task) for r in laid.withColumn("task", F.spark_partition_id()).collect()]
    groups.remove_rows(spark, path)
    assert sorted(i for _, i, _ in placed) == list(range(100_000))
    assert len({task for k, _, task in placed if k is None}) > 1
    assert [i for k, i, _ in sorted(placed, key=lambda row: row[2]) if k is None] == list(range(0, 100_000, 3))
    assert len({(k, task) for k, _, task in placed if k is not None}) == 5_000


def test_bytes_of_a_batch_are_heeded_unless_rows_are_short(spark):
    name, rows = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(20).select("id", (F.col("id") % 2).alias("k"))
    long_cells = rows.withColumn("cell", F.when(F.col("id") == 7, F.expr("repeat('x', 3000)")))
    nested, none = rows.withColumn("cell", F.array("id")), rows.filter(F.lit(False))
    assert [groups.in_runs(df, ["k"], ["id"])[2] for df in (rows, long_cells, nested, none)] == [True, False, False, False]
    assert not groups.in_runs(rows, ["k"], ["id"], stored=True)[2]
    was = spark.conf.get(name)
    with groups.batches_by_rows(spark, False):
        assert spark.conf.get(name) == was
    with groups.batches_by_rows(spark, True):
        assert spark.conf.get(name) != was
    assert spark.conf.get(name) == was
    for df in (rows, none):
        assert sorted(r.id for r in merge_group(df, ["k"], [F.col("id")], {"id": first()}).collect()) == [r.id for r in df.limit(2).collect()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of 150 orders with eight lines each."""
    at = str(tmp_path_factory.mktemp("tables"))
    tables = {
        "nation": (5, "cast(id as int) n_nationkey", "concat(substr('GACOBEKEUG', cast(2 * id + 1 as int), 2), ' land') n_name"),
        "customer": (20, "id c_custkey", "cast(id % 5 as int) c_nationkey", "concat('Doe', id, ', J') c_name"),
        "supplier": (30, "id s_suppkey", "concat('Poe', id, ', B') s_name"),
        "part": (60, "id p_partkey", "concat('annona', id % 3, ' alba') p_name", "concat('alba', id % 4) p_type", "concat('Brand#', id % 3) p_brand"),
        "orders": (150, "id o_orderkey", "id % 20 o_custkey", "substr('FOP', cast(id % 3 + 1 as int), 1) o_orderstatus", "id * 2.5D o_totalprice",
                   "date_add(date'1994-01-01', cast(id % 600 as int)) o_orderdate", "concat('P', id % 3) o_orderpriority"),
        "lineitem": (1200, "id % 150 l_orderkey", "cast(id div 150 % 7 + 1 as int) l_linenumber", "id * 7 % 60 l_partkey", "id * 11 % 30 l_suppkey",
                     "id * 1.5D l_extendedprice", "date_add(date'1995-01-01', cast(id % 900 as int)) l_shipdate", "substr('ANR', cast(id % 3 + 1 as int), 1) l_returnflag",
                     "if(id % 2 = 0, 'F', 'O') l_linestatus", "id % 9 * 0.01D l_tax", "id % 11 * 0.01D l_discount"),
    }
    for name, (rows, *columns) in tables.items():
        spark.range(rows).coalesce(1).selectExpr(*columns).write.parquet(f"{at}/{name}.parquet")
    return at


def in_parts_and_whole(spark, folder, monkeypatch, make):
    """What `make` gives for the view of files, worked on as a whole and in parts of few bytes, as sorted text."""
    whole = sorted(map(str, make(view.specimens(spark, folder), folder).collect()))
    seen = []

    class Noted(groups.Parts):
        def each(self, every=False):
            for part in super().each(every):
                seen.append(self.many)
                yield part

    for module in (groups, dedup, experts, merge, consolidate):
        monkeypatch.setattr(module, "Parts", Noted)
    monkeypatch.setattr(groups, "PART_BYTES", 12_000)
    monkeypatch.setattr(groups, "STORED_PART_BYTES", 24_000)
    parts = sorted(map(str, make(view.specimens(spark, folder), folder).collect()))
    assert sum(seen) > 1
    return whole, parts


def test_merges_in_parts(spark, folder, monkeypatch):
    """Rows of large files are shuffled part by part; the records are the same, cells and order included."""
    rules = {"colnum": first(), "k_order": first(), "cells": join(", ", "det_by")}
    whole, parts = in_parts_and_whole(spark, folder, monkeypatch, lambda df, _: merge_group(df, ["recorded_by", "colnum"], [F.col(c) for c in view.ORDER], rules))
    assert whole == parts and len(whole) > 100


def test_deduplication_in_parts(spark, folder, monkeypatch):
    def make(df, _):
        done = dedup.dedup_raw(df.filter("colnum is not null"), NUMBERED_KEYS, view.ORDER)
        columns = ["k_order", "k_line", "k_part", "k_supp", *NUMBERED_KEYS, "det_by"]
        return done.clean.select(*columns, F.lit(1).alias("clean")).unionByName(done.quarantine.select(*columns, F.lit(0).alias("clean")))

    whole, parts = in_parts_and_whole(spark, folder, monkeypatch, make)
    assert whole == parts


def test_experts_in_parts(spark, folder, monkeypatch):
    def make(df, folder):
        out = integrate_expert_by_number(df, expert_queries.experts(spark, folder, True, True).filter("k_order % 3 = 0"), view.ORDER)
        united = experts.integrate_expert(df.withColumn("barcode", F.expr("if(k_line % 7 > 0, barcode, null)")), expert_queries.experts(spark, folder), view.ORDER)
        columns = ["k_order", "k_line", "recorded_by", "colnum", "accepted_name", "expert_det", "det_by", "barcode"]
        return out.select(*columns).unionByName(united.select(*columns))

    whole, parts = in_parts_and_whole(spark, folder, monkeypatch, make)
    assert whole == parts


def test_updates_by_barcode_in_parts(spark, folder, monkeypatch):
    def make(df, folder):
        return experts.update_by_barcode(df, expert_queries.experts(spark, folder), ["k_order"], view.ORDER)

    whole, parts = in_parts_and_whole(spark, folder, monkeypatch, make)
    assert whole == parts


def test_consolidation_in_parts(spark, folder, monkeypatch):
    """Group sizes come from the scan that fills by barcode, also for runs that go over tasks."""
    def make(df, folder):
        return consolidate.consolidate_coordinates(df, geo_queries.areas(spark, folder), view.ORDER, F.lit("x")).quarantine

    whole, parts = in_parts_and_whole(spark, folder, monkeypatch, make)
    assert whole == parts and whole


def test_sizes_of_groups_from_a_scan(spark):
    rows = spark.range(50_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), F.lit(None).cast("string").alias("x"))
    sized = groups.crossfill(rows, ["k"], ["x"], ["id"], sizes="n").groupBy("k").agg(F.count("*").alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
    assert sized.count() == 51 and sized.filter("low <> rows or high <> rows").count() == 0


def test_expert_file_is_read_once(spark):
    """The size of a group is known when it is merged: it needs no join beforehand."""
    text = "genus specific_epithet recorded_by prefix colnum sufix colnum_full det_by country_iso3 locality barcode"
    rows = [(i, *("x" if c != "specific_epithet" else e for c in text.split()), 1900, 2000 + i, k) for i, e, k in ((1, "sp. alba", "a"), (2, "sp. alba", "b"), (3, "sp.", "b"))]
    made = spark.createDataFrame(rows, "k_order long, " + ", ".join(f"{c} string" for c in text.split()) + ", col_year int, det_year int, country string")
    code, done = counted(spark, F.col("locality"))
    made = made.withColumn("locality", code).withColumns({"ddlat": F.lit(1.0), "ddlong": F.lit(2.0), "expert_det": F.lit("E")})
    out = dedup.dedup_raw(made, ["recorded_by", "country"], ["k_order"], expert_file=True).clean
    assert sorted((r.country, r.specific_epithet) for r in out.collect()) == [("a", "sp. alba"), ("b", "alba")]
    assert done.value == 3
