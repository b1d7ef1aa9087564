"""What readers and corrections do to rows, on rows derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vasculum.functions.barcodes import tropicos_barcode
from vasculum.sources.readers import conform_raw, number_copies
from vasculum.sources.tables import apply_corrections
from workload.base import query, with_view
from workload.view import specimens, table

KEYS = ["k_order", "k_line", "k_part", "k_supp"]
KEYS_SQL = "k_order, k_line, k_part, k_supp"

# Values as provider files write them, once as SQL that both engines read alike.
WRITTEN = """SELECT l_orderkey AS k_order, l_linenumber AS k_line, l_partkey AS k_part, l_suppkey AS k_supp,
  CASE l_linenumber % 4 WHEN 0 THEN '0' WHEN 1 THEN '1998.0' WHEN 2 THEN 'n.d.' ELSE CAST(year(l_shipdate) AS STRING) END AS col_year,
  CASE l_suppkey % 4 WHEN 0 THEN '-9999' WHEN 1 THEN 'north' WHEN 2 THEN NULL ELSE concat(CAST(l_partkey % 90 AS STRING), '.5') END AS ddlat,
  l_linenumber - 3 AS det_day, l_partkey AS barcode, concat('x', CAST(l_suppkey AS STRING)) AS not_in_the_schema FROM lineitem"""


def _written(spark, folder):
    table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(WRITTEN)


@query("conform", f"""SELECT {KEYS_SQL}, CASE WHEN try_cast(try_cast(col_year AS DOUBLE) AS INTEGER) > 0 THEN try_cast(try_cast(col_year AS DOUBLE) AS INTEGER) END AS col_year,
  nullif(try_cast(ddlat AS DOUBLE), -9999) AS ddlat, CASE WHEN det_day > 0 THEN CAST(det_day AS INTEGER) END AS det_day, CAST(barcode AS VARCHAR) AS barcode,
  CAST(NULL AS VARCHAR) AS recorded_by FROM ({WRITTEN})""")
def conform(spark, folder):
    """Exactly the raw columns with their types: absent ones null, values that are not of the type null."""
    done = conform_raw(_written(spark, folder), KEYS)
    assert "not_in_the_schema" not in done.columns
    return done.select(*KEYS, "col_year", "ddlat", "det_day", "barcode", "recorded_by")


@query("tropicos_columns", f"""SELECT {KEYS_SQL}, 'MO' || CAST(k_part AS VARCHAR) AS barcode FROM ({WRITTEN})""")
def tropicos_columns(spark, folder):
    return _written(spark, folder).select(*KEYS, tropicos_barcode(F.col("k_part").cast("string")).alias("barcode"))


@query("corrections", with_view(select=f"""SELECT {KEYS_SQL}, CASE WHEN k_order % 3 = 0 THEN 'corrected' ELSE 'to correct' END AS state,
  CASE WHEN k_order % 3 = 0 AND k_order % 2 = 0 THEN 'Fixed, F' ELSE recorded_by END AS recorded_by,
  CASE WHEN k_order % 3 = 0 AND k_order % 2 = 1 THEN 'Mended, M' ELSE det_by END AS det_by FROM specimens"""))
def corrections(spark, folder):
    """Records corrected by hand beside those still to correct; an empty cell of a correction leaves the value."""
    failed = specimens(spark, folder).select(*KEYS, F.col("k_order").alias("record_id"), "recorded_by", "det_by")
    by_hand = failed.filter("k_order % 3 = 0").select(
        "record_id", F.when(F.col("record_id") % 2 == 0, "Fixed, F").alias("recorded_by"), F.when(F.col("record_id") % 2 == 1, "Mended, M").alias("det_by")
    )
    parts = apply_corrections(failed, by_hand, ["recorded_by", "det_by"])
    states = [part.withColumn("state", F.lit(state)) for part, state in zip(parts, ("corrected", "to correct"), strict=True)]
    return states[0].unionByName(states[1]).drop("record_id")


def _part_sql(c):
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(length({c}) AS VARCHAR) || ':' || {c} END"


# Rows of few columns, so that many are equal; some cells are null, some empty.
REPEATED = """SELECT l_linestatus, CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE l_returnflag END AS flag,
  CASE WHEN l_partkey % 3 > 0 THEN CAST(l_suppkey AS STRING) END AS number FROM lineitem"""


@query("record_ids", f"""SELECT *, md5('1:T|0:|' || {" || '|' || ".join(map(_part_sql, ("l_linestatus", "flag", "number")))})
  || '-' || CAST(row_number() OVER (PARTITION BY l_linestatus, flag, number) AS VARCHAR) AS record_id FROM ({REPEATED})""")
def record_ids(spark, folder):
    """An id for every row, equal rows included."""
    table(spark, folder, "lineitem").createOrReplaceTempView("lineitem")
    return number_copies(spark.sql(REPEATED), F.lit("T"), F.lit(""))
