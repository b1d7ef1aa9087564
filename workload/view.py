"""The specimen view: occurrence records derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Total order of the records; the first column is a number.
ORDER = ["k_order", "k_line", "k_part", "k_supp", "k_price", "k_ship"]


#: Records that one task joins at most, about; a smaller table is left to Spark.
JOINED_ROWS = 250_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def specimens(spark: SparkSession, folder: str) -> DataFrame:
    l, o, c, n, s, p = (
        table(spark, folder, t) for t in ("lineitem", "orders", "customer", "nation", "supplier", "part")
    )
    records = l.count()  # from the files' footers
    if records > 40 * JOINED_ROWS:  # narrow rows shrink so well that Spark would join millions of them in one task
        l = l.repartition(records // JOINED_ROWS, "l_orderkey").hint("merge")
    # Orders meet their customers first: they are fewer and narrower than their lines.
    placed = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    rows = (
        l.join(placed, l.l_orderkey == o.o_orderkey)
        .join(s, l.l_suppkey == s.s_suppkey)
        .join(p, l.l_partkey == p.p_partkey)
    )
    number = (F.col("o_orderkey") % 500).cast("string")
    sufix = F.when(F.col("l_linenumber") == 7, F.lit("A"))
    prefix = F.when(F.col("l_linenumber") % 5 == 0, F.lit("SJ"))
    epithet = F.when(F.col("l_partkey") % 11 != 0, F.col("p_type"))
    genus = F.split_part("p_name", F.lit(" "), F.lit(1))
    step = F.when(F.col("o_orderkey") % 10 == 0, F.col("l_linenumber").cast("double")).otherwise(
        F.lit(0.01) * F.col("l_linenumber")
    )
    present = F.col("l_suppkey") % 13 != 0
    barcode = F.concat(F.substring("n_name", 1, 2), (F.col("l_orderkey") * 7 % 100000).cast("string"))
    return rows.select(
        F.col("l_orderkey").alias("k_order"),
        F.col("l_linenumber").alias("k_line"),
        F.col("l_partkey").alias("k_part"),
        F.col("l_suppkey").alias("k_supp"),
        F.col("l_extendedprice").alias("k_price"),
        F.col("l_shipdate").alias("k_ship"),
        F.when(F.col("l_returnflag") == "A", "gbif")
        .when(F.col("l_returnflag") == "N", "P_herbo")
        .otherwise("brahms").alias("source_id"),
        genus.alias("genus"),
        epithet.alias("specific_epithet"),
        F.col("c_name").alias("recorded_by"),
        prefix.alias("prefix"),
        F.when(F.col("l_suppkey") % 9 != 0, number).alias("colnum"),
        sufix.alias("sufix"),
        F.when(
            F.col("l_suppkey") % 9 != 0,
            F.concat(F.coalesce(prefix, F.lit("")), number, F.coalesce(sufix, F.lit(""))),
        ).alias("colnum_full"),
        F.year("o_orderdate").alias("col_year"),
        F.month("o_orderdate").alias("col_month"),
        F.dayofmonth("o_orderdate").alias("col_day"),
        F.col("s_name").alias("det_by"),
        F.when(F.col("l_linenumber") % 3 != 0, F.year("l_shipdate")).alias("det_year"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("C"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_iso3"),
        F.col("p_brand").alias("locality"),
        F.when(present, (F.col("o_orderkey") % 170 - 85).cast("double") + step).alias("ddlat"),
        F.when(present, (F.col("o_custkey") % 340 - 170).cast("double") + step).alias("ddlong"),
        F.when(F.col("l_linestatus") == "F", "K").otherwise("AAU").alias("institute"),
        F.col("p_brand").alias("herbarium_code"),
        barcode.alias("barcode"),
        F.when(F.col("l_linenumber") % 4 != 0, barcode).alias("orig_bc"),
        F.col("c_name").alias("orig_recby"),
        F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("u"), F.col("l_partkey").cast("string"))).alias("link"),
        F.when(F.col("o_orderstatus") == "F", "ACCEPTED").when(F.col("o_orderstatus") == "O", "SYNONYM").alias("status"),
        F.when(F.col("l_partkey") % 17 != 0, F.concat(genus, F.lit(" "), epithet)).alias("accepted_name"),
        F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("n"), F.col("l_partkey").cast("string"))).alias("ipni_no"),
        F.when(F.col("l_tax") < 0.005, "EXP").alias("expert_det"),
        F.when(F.col("l_discount") > 0.095, "seas").alias("geo_issues"),
        F.lit(None).cast("string").alias("modified"),
    )


# The same view for the SQL check.
SPECIMENS_SQL = """
specimens AS (
  SELECT l_orderkey AS k_order, l_linenumber AS k_line, l_partkey AS k_part,
    l_suppkey AS k_supp, l_extendedprice AS k_price, l_shipdate AS k_ship,
    CASE l_returnflag WHEN 'A' THEN 'gbif' WHEN 'N' THEN 'P_herbo' ELSE 'brahms' END AS source_id,
    split_part(p_name, ' ', 1) AS genus,
    CASE WHEN l_partkey % 11 <> 0 THEN p_type END AS specific_epithet,
    c_name AS recorded_by,
    CASE WHEN l_linenumber % 5 = 0 THEN 'SJ' END AS prefix,
    CASE WHEN l_suppkey % 9 <> 0 THEN CAST(o_orderkey % 500 AS VARCHAR) END AS colnum,
    CASE WHEN l_linenumber = 7 THEN 'A' END AS sufix,
    CASE WHEN l_suppkey % 9 <> 0 THEN
      CASE WHEN l_linenumber % 5 = 0 THEN 'SJ' ELSE '' END || CAST(o_orderkey % 500 AS VARCHAR)
      || CASE WHEN l_linenumber = 7 THEN 'A' ELSE '' END END AS colnum_full,
    CAST(year(o_orderdate) AS INTEGER) AS col_year, CAST(month(o_orderdate) AS INTEGER) AS col_month,
    CAST(day(o_orderdate) AS INTEGER) AS col_day,
    s_name AS det_by,
    CASE WHEN l_linenumber % 3 <> 0 THEN CAST(year(l_shipdate) AS INTEGER) END AS det_year,
    n_name AS country,
    'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_iso3,
    p_brand AS locality,
    CASE WHEN l_suppkey % 13 <> 0 THEN CAST(o_orderkey % 170 - 85 AS DOUBLE)
      + CASE WHEN o_orderkey % 10 = 0 THEN CAST(l_linenumber AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) * l_linenumber END END AS ddlat,
    CASE WHEN l_suppkey % 13 <> 0 THEN CAST(o_custkey % 340 - 170 AS DOUBLE)
      + CASE WHEN o_orderkey % 10 = 0 THEN CAST(l_linenumber AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) * l_linenumber END END AS ddlong,
    CASE WHEN l_linestatus = 'F' THEN 'K' ELSE 'AAU' END AS institute,
    p_brand AS herbarium_code,
    substr(n_name, 1, 2) || CAST(l_orderkey * 7 % 100000 AS VARCHAR) AS barcode,
    CASE WHEN l_linenumber % 4 <> 0 THEN substr(n_name, 1, 2) || CAST(l_orderkey * 7 % 100000 AS VARCHAR) END AS orig_bc,
    c_name AS orig_recby,
    CASE WHEN l_partkey % 7 <> 0 THEN 'u' || CAST(l_partkey AS VARCHAR) END AS link,
    CASE o_orderstatus WHEN 'F' THEN 'ACCEPTED' WHEN 'O' THEN 'SYNONYM' END AS status,
    CASE WHEN l_partkey % 17 <> 0 AND l_partkey % 11 <> 0 THEN split_part(p_name, ' ', 1) || ' ' || p_type END AS accepted_name,
    CASE WHEN l_partkey % 5 <> 0 THEN 'n' || CAST(l_partkey AS VARCHAR) END AS ipni_no,
    CASE WHEN l_tax < 0.005 THEN 'EXP' END AS expert_det,
    CASE WHEN l_discount > 0.095 THEN 'seas' END AS geo_issues,
    CAST(NULL AS VARCHAR) AS modified
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
"""
