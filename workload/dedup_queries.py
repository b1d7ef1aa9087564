"""Grouping, merging and deduplication over the specimen view."""

from __future__ import annotations

from pyspark.sql import functions as F

from vasculum.functions.names import surname
from vasculum.operators import filters, groups, rules as R, stats
from vasculum.operators.dedup import dedup_master, dedup_raw, diverging_identifications
from vasculum.operators.merge import (
    ascending_nulls_last, expert_first, first, merge_group, newest_first,
)
from vasculum.operators.premerge import explode_barcodes, premerge, present, reduce_cells
from vasculum.plans.filer import integrate
from vasculum.schema import (
    EXPERT_KEYS, GATHERING_KEYS, MASTER_SN_KEYS, NUMBERED_KEYS, RAW_SN_KEYS,
)
from vasculum.sources.tables import conservation, run_stamp
from workload.base import (
    EXPERT_FIRST, GATHERING, NEWEST, NUMBERED, STATUS, TIE, TIE_COLUMNS, VIEW_COLUMNS,
    columns_sql, dedup_sql, first_sql, query, rest, rounded, tidy, tidy_sql, tokens_sql, with_view,
)
from workload.view import ORDER, specimens



def stamp():
    return run_stamp("curator", "2024-01-01_00-00-00")


def newest():
    return [*newest_first(), *map(F.col, ORDER)]


STAMP_SQL = "'curator_2024-01-01_00-00-00'"
RAW_LISTS = {
    "join": ["det_by", "institute", "herbarium_code", "colnum_full", "orig_bc"],
    "whole": ["barcode", "source_id", "link"],
}
NOT_RAW = ["status", "accepted_name", "ipni_no", "geo_issues", "modified"]
MASTER_LISTS = {
    "join": ["det_by", "institute", "herbarium_code", "colnum_full", "geo_issues", "modified"],
    "whole": ["barcode", "orig_bc", "source_id", "link"],
}
NAMED = ["accepted_name", "genus", "specific_epithet", "status", "ipni_no"]
COORDS = ["ddlat", "ddlong"]


# --- filters and routes -------------------------------------------------------------------


@query("blocklist", with_view(select=tidy_sql("specimens WHERE institute IS NULL OR institute NOT IN ('AU', 'AAU')")))
def blocklist(spark, folder):
    return tidy(filters.keep_usable_institutes(specimens(spark, folder)))


@query("routes", with_view(select="""SELECT k_order, k_line, k_part, k_supp,
  CASE WHEN accepted_name IS NULL THEN 'indet' WHEN ddlat IS NULL THEN 'coord'
       WHEN recorded_by IS NULL OR colnum IS NULL THEN 'quarantine' ELSE 'master' END AS route FROM specimens"""))
def routes(spark, folder):
    return filters.with_route(specimens(spark, folder)).select("k_order", "k_line", "k_part", "k_supp", "route")


@query("route_counts", with_view(select="""SELECT CASE WHEN accepted_name IS NULL THEN 'indet' WHEN ddlat IS NULL THEN 'coord'
       WHEN recorded_by IS NULL OR colnum IS NULL THEN 'quarantine' ELSE 'master' END AS route, count(*) AS records FROM specimens GROUP BY 1"""))
def route_counts(spark, folder):
    return stats.route_counts(filters.with_route(specimens(spark, folder)))


@query("prefix_surname", with_view(select="""SELECT k_order, k_line, k_part, k_supp,
  CASE WHEN split_part(who, ',', 1) = prefix THEN NULL ELSE prefix END AS prefix
  FROM (SELECT *, CASE WHEN k_line % 2 = 0 THEN 'SJ, A' ELSE recorded_by END AS who FROM specimens)"""))
def prefix_surname(spark, folder):
    who = F.when(F.col("k_line") % 2 == 0, "SJ, A").otherwise(F.col("recorded_by"))
    df = filters.clear_surname_prefix(specimens(spark, folder).withColumn("recorded_by", who))
    return df.select("k_order", "k_line", "k_part", "k_supp", "prefix")


@query("usable_keys", with_view(select="""SELECT count(*) FILTER (WHERE colnum IS NOT NULL) AS usable,
  count(*) FILTER (WHERE colnum IS NULL) AS unusable FROM specimens"""))
def usable_keys(spark, folder):
    good, bad = filters.split_usable_key(specimens(spark, folder))
    return good.agg(F.count(F.lit(1)).alias("usable"), F.lit(0).cast("long").alias("unusable")).unionByName(
        bad.agg(F.lit(0).cast("long").alias("usable"), F.count(F.lit(1)).alias("unusable"))
    ).agg(F.sum("usable").alias("usable"), F.sum("unusable").alias("unusable"))


@query("conservation", with_view(select="SELECT count(*) AS before, count(*) AS after, true AS conserved FROM specimens"))
def conserved(spark, folder):
    df = specimens(spark, folder)
    return conservation(df, *filters.split_numbered(df))


@query("expert_defaults", with_view(select="""SELECT k_order, k_line, k_part, k_supp, 'ACCEPTED' AS status,
  genus || ' ' || specific_epithet AS accepted_name, 'expert_det_file' AS expert_det FROM specimens"""))
def expert_defaults(spark, folder):
    df = filters.flag_expert(filters.expert_defaults(specimens(spark, folder)), True)
    return df.select("k_order", "k_line", "k_part", "k_supp", "status", "accepted_name", "expert_det")


@query("indet_names", with_view(select="""SELECT k_order, k_line, k_part, k_supp,
  CASE WHEN specific_epithet IS NOT NULL THEN accepted_name END AS accepted_name,
  CASE WHEN specific_epithet IS NOT NULL THEN status END AS status,
  CASE WHEN specific_epithet IS NOT NULL THEN expert_det END AS expert_det FROM specimens"""))
def indet_names(spark, folder):
    return filters.clear_names_of_indets(specimens(spark, folder)).select(
        "k_order", "k_line", "k_part", "k_supp", "accepted_name", "status", "expert_det"
    )


@query("artefacts", with_view(select="""SELECT recorded_by, prefix, sufix FROM specimens
  WHERE NOT (prefix IS NULL AND sufix IS NULL)"""))
def artefacts(spark, folder):
    # Only the collector is filled in some rows: one distinct value, an artefact.
    return filters.drop_artefacts(specimens(spark, folder).select("recorded_by", "prefix", "sufix"))


@query("missing_values", with_view(select="""SELECT count(*) - count(accepted_name) AS accepted_name,
  count(*) - count(det_by) AS det_by, count(*) - count(det_year) AS det_year FROM specimens"""))
def missing_values(spark, folder):
    return filters.count_missing(specimens(spark, folder), ["accepted_name", "det_by", "det_year"])


@query("required_values", with_view(select="SELECT count(*) AS records, count(DISTINCT recorded_by) AS collectors FROM specimens"))
def required_values(spark, folder):
    return filters.require(specimens(spark, folder), ["recorded_by", "det_by"]).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("recorded_by").alias("collectors")
    )


# --- statistics -----------------------------------------------------------------------------


def _stats_sql(key_sets) -> str:
    parts = [
        f"SELECT '{name}' AS key_set, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicated_records "
        f"FROM (SELECT count(*) AS n FROM numbered GROUP BY {', '.join(keys)})"
        for name, keys in key_sets.items()
    ]
    return with_view(
        "numbered AS (SELECT *, split_part(recorded_by, ',', 1) AS coll_surname, recorded_by AS huh_name "
        "FROM specimens WHERE colnum IS NOT NULL)",
        select=" UNION ALL ".join(parts),
    )


@query("dup_stats", _stats_sql(stats.DUPLICATE_KEY_SETS))
def dup_stats(spark, folder):
    return stats.duplicate_stats(specimens(spark, folder).withColumn("huh_name", F.col("recorded_by")))


@query("dup_stats_premerge", _stats_sql(stats.PREMERGE_KEY_SETS))
def dup_stats_premerge(spark, folder):
    return stats.duplicate_stats(specimens(spark, folder), stats.PREMERGE_KEY_SETS)


@query("dup_stats_consolidation", _stats_sql(stats.CONSOLIDATION_KEY_SETS))
def dup_stats_consolidation(spark, folder):
    return stats.duplicate_stats(specimens(spark, folder), stats.CONSOLIDATION_KEY_SETS)


@query("record_counts", with_view(select="SELECT count(*) AS total, count(colnum) AS numbered, count(*) - count(colnum) AS without_number FROM specimens"))
def record_counts(spark, folder):
    return stats.record_counts(specimens(spark, folder))


@query("unique_collectors", with_view(select="SELECT DISTINCT recorded_by FROM specimens"))
def unique_collectors(spark, folder):
    return stats.unique_collectors(specimens(spark, folder))


def _diverging_sql(names: str) -> str:
    return with_view(select=f"""SELECT count(*) AS diverging_records FROM (SELECT
      count(*) OVER (PARTITION BY col_year, colnum_full, country) AS place,
      count(*) OVER (PARTITION BY recorded_by, colnum_full, {names}) AS named FROM specimens) WHERE place > 1 AND named = 1""")


@query("diverging_raw", _diverging_sql("specific_epithet, genus"))
def diverging_raw(spark, folder):
    return diverging_identifications(specimens(spark, folder), ["specific_epithet", "genus"])


@query("diverging_master", _diverging_sql("accepted_name"))
def diverging_master(spark, folder):
    return diverging_identifications(specimens(spark, folder), ["accepted_name"])


# --- groups ---------------------------------------------------------------------------------


@query("is_duplicate", with_view(select=f"""SELECT k_order, k_line, k_part, k_supp,
  count(*) OVER (PARTITION BY {NUMBERED}) > 1 AS is_duplicate FROM specimens"""))
def is_duplicate(spark, folder):
    df = groups.is_duplicate(specimens(spark, folder).select(*ORDER, *NUMBERED_KEYS), NUMBERED_KEYS)
    return df.select("k_order", "k_line", "k_part", "k_supp", "is_duplicate")


@query("keep_last", with_view(select="""SELECT k_order, k_line, k_part, k_supp, accepted_name FROM (SELECT *,
  row_number() OVER (PARTITION BY accepted_name ORDER BY k_order DESC, k_line DESC, k_part DESC, k_supp DESC, k_price DESC, k_ship DESC) AS rn
  FROM specimens) WHERE rn = 1"""))
def keep_last(spark, folder):
    df = specimens(spark, folder).select(*ORDER, "accepted_name")
    late = [-F.col(c) for c in ORDER[:-1]] + [-F.unix_micros(F.col("k_ship").cast("timestamp"))]
    return groups.drop_duplicates_by(df, ["accepted_name"], late).select(
        "k_order", "k_line", "k_part", "k_supp", "accepted_name"
    )


@query("coordinate_variance", with_view(select=f"""SELECT k_order, k_line, k_part, k_supp, n,
  round(var_samp(ddlat) OVER w + 0.00000003, 6) AS lat_var, round(var_samp(ddlong) OVER w + 0.00000003, 6) AS long_var,
  round(avg(ddlat) OVER w + 0.00000003, 6) AS lat_mean, round(avg(ddlong) OVER w + 0.00000003, 6) AS long_mean
  FROM (SELECT *, count(*) OVER (PARTITION BY {NUMBERED}) AS n FROM specimens) WINDOW w AS (PARTITION BY {NUMBERED})"""))
def coordinate_variance(spark, folder):
    values = {
        "n": F.count(F.lit(1)), "lat_var": F.var_samp("ddlat"), "long_var": F.var_samp("ddlong"),
        "lat_mean": F.avg("ddlat"), "long_mean": F.avg("ddlong"),
    }
    df = groups.with_group_values(specimens(spark, folder).select(*ORDER, *NUMBERED_KEYS, *COORDS), NUMBERED_KEYS, values)
    return df.select(
        "k_order", "k_line", "k_part", "k_supp", "n", *[rounded(F.col(c)).alias(c) for c in list(values)[1:]]
    )


FILL_SQL = "coalesce(last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
_GATHER_W = f"PARTITION BY {GATHERING} ORDER BY {TIE}"


@query("crossfill_coordinates", with_view(select=f"""SELECT k_order, k_line, k_part, k_supp,
  round({FILL_SQL.format(c='ddlat', w=_GATHER_W)} + 0.00000003, 6) AS ddlat,
  round({FILL_SQL.format(c='ddlong', w=_GATHER_W)} + 0.00000003, 6) AS ddlong FROM specimens"""))
def crossfill_coordinates(spark, folder):
    df = specimens(spark, folder).select(*ORDER, *GATHERING_KEYS, *COORDS)
    return tidy(groups.crossfill(df, GATHERING_KEYS, COORDS, ORDER)).select("k_order", "k_line", "k_part", "k_supp", *COORDS)


@query("newest_determination", with_view(select="SELECT k_order, k_line, k_part, k_supp, " + ", ".join(
    f"first_value({c} IGNORE NULLS) OVER (PARTITION BY {NUMBERED} ORDER BY {NEWEST} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}"
    for c in NAMED) + " FROM specimens"))
def newest_determination(spark, folder):
    df = specimens(spark, folder).select(*ORDER, *NUMBERED_KEYS, "det_year", *NAMED)
    rank = F.struct(*newest())
    best = {"best_" + c: F.min_by(c, F.when(F.col(c).isNotNull(), rank)) for c in NAMED}
    out = groups.with_group_values(df, NUMBERED_KEYS, best)
    return out.select("k_order", "k_line", "k_part", "k_supp", *[F.col("best_" + c).alias(c) for c in NAMED])


@query("number_in_group", with_view(select=f"""SELECT k_order, k_line, k_part, k_supp,
  det_by || '_det_' || CAST(row_number() OVER (PARTITION BY det_by ORDER BY {TIE}) AS VARCHAR) AS barcode FROM specimens"""))
def number_in_group(spark, folder):
    df = specimens(spark, folder).select(*ORDER, "det_by").withColumn("who", surname(F.col("det_by")))
    out = groups.number_in_group(df, ["who"], ORDER, "number")
    return out.select(
        "k_order", "k_line", "k_part", "k_supp", F.concat("who", F.lit("_det_"), F.col("number").cast("string")).alias("barcode")
    )


# --- merges ---------------------------------------------------------------------------------


def merged_sql(source: str, keys: str, order: str, drop=(), **lists) -> str:
    """Merge every column of the view that is not in `lists` by first value."""
    used = [c for names in lists.values() for c in names]
    firsts = [c for c in VIEW_COLUMNS if c not in used and c not in drop]
    return f"SELECT {columns_sql(order, first=firsts + TIE_COLUMNS, **lists)} FROM {source} GROUP BY {keys}"


def merge_query(name: str, table, keys: list[str], order, order_sql: str, drop=(), **lists):
    """A bare merge: kernel and rule table, without the steps around it."""

    @query(name, with_view(f"merged AS ({merged_sql('specimens', ', '.join(keys), order_sql, drop, **lists)})", select=tidy_sql("merged")))
    def run(spark, folder):
        df = specimens(spark, folder)
        return tidy(merge_group(df, keys, order(), present(df, table, ORDER)))

    return run


merge_query("merge_raw", R.raw_merge(), NUMBERED_KEYS, lambda: [expert_first(), *newest()], f"{EXPERT_FIRST}, {NEWEST}",
            [*NOT_RAW, "orig_recby", "expert_det"], **RAW_LISTS)
merge_query("merge_barcode_expert", R.barcode_merge(True), ["barcode"], lambda: [expert_first(), *newest()], f"{EXPERT_FIRST}, {NEWEST}",
            ["orig_recby", "modified", "geo_issues"], join=["det_by", "institute", "herbarium_code"],
            whole=["orig_bc", "source_id", "link", "colnum_full"])
merge_query("merge_barcode", R.barcode_merge(False), ["barcode"], lambda: [expert_first(), *newest()], f"{EXPERT_FIRST}, {NEWEST}",
            ["orig_recby", "modified", "geo_issues"], join=["det_by", "institute", "herbarium_code"],
            whole=["orig_bc", "source_id", "link"])
merge_query("merge_key_by_status", R.key_merge(), NUMBERED_KEYS, lambda: [*ascending_nulls_last("status"), *newest()], f"{STATUS}, {NEWEST}",
            ["orig_recby"], **MASTER_LISTS)
merge_query("merge_key_expert_first", R.expert_over_master_merge(), NUMBERED_KEYS, lambda: [*ascending_nulls_last("status"), expert_first(), *newest()],
            f"{STATUS}, {EXPERT_FIRST}, {NEWEST}", ["orig_recby"],
            join=[c for c in MASTER_LISTS["join"] if c != "colnum_full"], whole=MASTER_LISTS["whole"])
merge_query("merge_self", R.self_merge(), EXPERT_KEYS, lambda: [*ascending_nulls_last("status"), *newest()], f"{STATUS}, {NEWEST}",
            join=["geo_issues", "modified"],
            whole=["colnum_full", "det_by", "institute", "herbarium_code", "barcode", "orig_bc", "orig_recby", "link", "source_id"])


# --- deduplication of one file --------------------------------------------------------------


def reconcile_sql(source: str, keys: str, masked: bool, tie: str = "") -> str:
    """Counted and coordinate-filled rows."""
    usable = "n > 1 AND geo_issues IS NULL" if masked else "n > 1"
    window = f"PARTITION BY {GATHERING}, n > 1 ORDER BY {TIE}{tie}"
    fills = ", ".join(f"coalesce(CASE WHEN n > 1 THEN {FILL_SQL.format(c='f_' + c, w=window)} END, {c}) AS {c}" for c in COORDS)
    return f"""counted AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n FROM {source}),
masked AS (SELECT *, CASE WHEN {usable} THEN ddlat END AS f_ddlat, CASE WHEN {usable} THEN ddlong END AS f_ddlong FROM counted),
filled AS (SELECT * REPLACE ({fills}) FROM masked)"""


AGREES = "HAVING coalesce(var_samp(ddlat) <= 0.1, true) AND coalesce(var_samp(ddlong) <= 0.1, true)"
MEANS = "avg(ddlat) AS ddlat, avg(ddlong) AS ddlong"
EPITHET_SQL = "CASE WHEN n > 1 THEN nullif(array_to_string(list_filter(string_split(specific_epithet, ' '), lambda t: t NOT IN ('sp.', 'indet.')), ' '), '') ELSE specific_epithet END"


def raw_sql(rows: str, keys: str) -> str:
    order = f"{EXPERT_FIRST}, {NEWEST}"
    firsts = rest(RAW_LISTS["join"], RAW_LISTS["whole"], NOT_RAW, COORDS, ["genus", "specific_epithet"])
    return with_view(
        f"rows_ AS (SELECT * FROM specimens WHERE {rows})",
        reconcile_sql("rows_", keys, False),
        f"merged AS (SELECT {columns_sql(order, first=firsts + TIE_COLUMNS, **RAW_LISTS)}, "
        f"{first_sql('genus', NEWEST)}, {first_sql('specific_epithet', NEWEST, EPITHET_SQL)}, {MEANS} "
        f"FROM filled GROUP BY {keys} {AGREES})",
        select=tidy_sql("merged"),
    )


@query("dedup_numbered", raw_sql("colnum IS NOT NULL", NUMBERED))
def dedup_numbered(spark, folder):
    rows, _ = filters.split_numbered(specimens(spark, folder))
    return tidy(dedup_raw(rows, NUMBERED_KEYS, ORDER).clean)


@query("dedup_unnumbered", raw_sql("colnum IS NULL", ", ".join(RAW_SN_KEYS)))
def dedup_unnumbered(spark, folder):
    _, rows = filters.split_numbered(specimens(spark, folder))
    return tidy(dedup_raw(rows, RAW_SN_KEYS, ORDER).clean)


@query("dedup_quarantine", with_view(
    "rows_ AS (SELECT * FROM specimens WHERE colnum IS NOT NULL)", reconcile_sql("rows_", NUMBERED, False),
    f"""spread AS (SELECT *, var_samp(ddlat) OVER (PARTITION BY {NUMBERED}) AS vlat, var_samp(ddlong) OVER (PARTITION BY {NUMBERED}) AS vlong FROM filled)""",
    select=tidy_sql("spread WHERE NOT (coalesce(vlat <= 0.1, true) AND coalesce(vlong <= 0.1, true))",
                    drop="k_price, k_ship, n, f_ddlat, f_ddlong, vlat, vlong")))
def dedup_quarantine(spark, folder):
    rows, _ = filters.split_numbered(specimens(spark, folder))
    return tidy(dedup_raw(rows, NUMBERED_KEYS, ORDER).quarantine)


@query("dedup_expert_file", with_view(
    f"counted AS (SELECT *, count(*) OVER (PARTITION BY {NUMBERED}) AS n FROM specimens)",
    f"merged AS (SELECT {columns_sql(f'{EXPERT_FIRST}, {NEWEST}', first=rest(RAW_LISTS['join'], RAW_LISTS['whole'], NOT_RAW, ['genus', 'specific_epithet']) + TIE_COLUMNS, **RAW_LISTS)}, "
    f"{first_sql('genus', NEWEST)}, {first_sql('specific_epithet', NEWEST, EPITHET_SQL)} FROM counted GROUP BY {NUMBERED})",
    select=tidy_sql("merged")))
def dedup_expert_file(spark, folder):
    return tidy(dedup_raw(specimens(spark, folder), NUMBERED_KEYS, ORDER, expert_file=True).clean)


# --- deduplication of the master table ------------------------------------------------------


def master_merge_sql(source: str, keys: str, tag: str = "", tie: str = "") -> str:
    """Chain of CTEs ending in `merged`; `tag` keeps several chains apart, `tie` is
    added to the order of records."""
    order, newest_ = f"{EXPERT_FIRST}, {NEWEST}{tie}", NEWEST + tie
    firsts = rest(MASTER_LISTS["join"], MASTER_LISTS["whole"], NAMED, COORDS, ["modified"])
    lists = {"join": [c for c in MASTER_LISTS["join"] if c != "modified"], "whole": MASTER_LISTS["whole"]}
    chain = reconcile_sql(source, keys, True, tie) + f""",
merged AS (SELECT {columns_sql(order, first=firsts + TIE_COLUMNS, **lists)},
{columns_sql(newest_, first=NAMED)}, {MEANS}, {STAMP_SQL} AS modified FROM filled GROUP BY {keys} {AGREES})"""
    for word in ("counted", "masked", "filled", "merged"):
        chain = chain.replace(f"{word} AS", f"{word}{tag} AS").replace(f"FROM {word} ", f"FROM {word}{tag} ").replace(f"FROM {word})", f"FROM {word}{tag})")
    return chain


BARCODE_CTE = "coded AS (" + merged_sql(
    "specimens", "barcode", f"{EXPERT_FIRST}, {NEWEST}", join=["det_by", "institute", "herbarium_code"],
    whole=["orig_bc", "source_id", "link"]) + ")"


@query("master_numbered", with_view("rows_ AS (SELECT * FROM specimens WHERE colnum IS NOT NULL)",
                                    BARCODE_CTE.replace("FROM specimens", "FROM rows_"), master_merge_sql("coded", NUMBERED), select=tidy_sql("merged")))
def master_numbered(spark, folder):
    rows, _ = filters.split_numbered(specimens(spark, folder))
    return tidy(dedup_master(rows, NUMBERED_KEYS, ORDER, stamp()).clean)


@query("master_unnumbered", with_view("rows_ AS (SELECT * FROM specimens WHERE colnum IS NULL)",
                                      master_merge_sql("rows_", ", ".join(MASTER_SN_KEYS)), select=tidy_sql("merged")))
def master_unnumbered(spark, folder):
    _, rows = filters.split_numbered(specimens(spark, folder))
    return tidy(dedup_master(rows, MASTER_SN_KEYS, ORDER, stamp(), unique_barcodes=True).clean)


_SIDED = columns_sql(f"{STATUS}, {NEWEST}", first=rest(MASTER_LISTS["join"], MASTER_LISTS["whole"]) + TIE_COLUMNS, **MASTER_LISTS)
_BOTH = columns_sql(f"(CASE WHEN side THEN 0 ELSE 1 END), {TIE}",
                    first=rest(MASTER_LISTS["join"], MASTER_LISTS["whole"]) + ["colnum_full"] + TIE_COLUMNS,
                    join=["det_by", "institute", "herbarium_code", "geo_issues"], whole=MASTER_LISTS["whole"])


@query("master_expert", with_view(
    f"sided AS (SELECT {_SIDED}, expert_det IS NOT NULL AS side FROM specimens GROUP BY {NUMBERED}, expert_det IS NOT NULL)".replace(", expert_det IS NOT NULL AS side", ", bool_or(expert_det IS NOT NULL) AS side"),
    f"merged AS (SELECT {_BOTH}, {STAMP_SQL} AS modified FROM sided GROUP BY {NUMBERED})",
    select=tidy_sql("merged")))
def master_expert(spark, folder):
    return tidy(dedup_master(specimens(spark, folder), NUMBERED_KEYS, ORDER, stamp(), expert=True, unique_barcodes=True).clean)


# --- merging by barcode, and filing ---------------------------------------------------------

CELLS = ["colnum_full", "det_by", "institute", "herbarium_code", "barcode", "orig_bc", "link", "geo_issues", "orig_recby", "source_id", "modified"]
_SEP = {"det_by": " / ", "link": " - "}
PREMERGE_CELLS = ["source_id", "colnum_full", "institute", "herbarium_code", "geo_issues", "barcode", "det_by", "link", "orig_recby"]
FILING_CELLS = ["source_id", "colnum_full", "institute", "herbarium_code", "orig_bc", "geo_issues", "det_by", "link", "orig_recby", "modified", "barcode"]
NEW_BARCODE = "CASE WHEN source_id = 'brahms' THEN barcode || ', X' || CAST(k_part % 1000 AS VARCHAR) || ', ' || barcode ELSE barcode END"


def new_and_old(spark, folder):
    """(master, backlogs, new): the view by source, the new records with several barcodes."""
    df = specimens(spark, folder)
    cell = F.concat("barcode", F.lit(", X"), (F.col("k_part") % 1000).cast("string"), F.lit(", "), "barcode")
    by_source = {s: df.filter(F.col("source_id") == s) for s in ("gbif", "P_herbo", "brahms")}
    return by_source["gbif"], by_source["P_herbo"], by_source["brahms"].withColumn("barcode", cell)


def _reduce(cells: list[str]) -> str:
    return ", ".join(f"{dedup_sql(c, _SEP.get(c, ', '))} AS {c}" for c in cells)


def sorted_set(c: str) -> str:
    return f"array_to_string(list_sort({tokens_sql(c)}), ', ')"


_RANK = f"{EXPERT_FIRST}, {STATUS}, {NEWEST}"
PREMERGE_CTES = f"""together AS (SELECT * REPLACE ({NEW_BARCODE} AS barcode) FROM specimens),
reduced AS (SELECT * REPLACE ({_reduce(PREMERGE_CELLS)}) FROM together),
exploded AS (SELECT *, unnest({tokens_sql('barcode')}) AS barcode_split FROM reduced),
single AS (SELECT {columns_sql(_RANK, first=rest(CELLS) + TIE_COLUMNS, join=CELLS)}, barcode_split FROM exploded GROUP BY barcode_split),
sets AS (SELECT * REPLACE ({sorted_set('barcode')} AS barcode) FROM single),
united AS (SELECT {columns_sql(_RANK + ', barcode_split', first=rest(CELLS) + TIE_COLUMNS, join=[c for c in CELLS if c != 'barcode'])}, barcode FROM sets GROUP BY barcode)"""


@query("barcode_explode", with_view(f"together AS (SELECT * REPLACE ({NEW_BARCODE} AS barcode) FROM specimens)",
       select=f"SELECT k_order, k_line, k_part, k_supp, unnest({tokens_sql('barcode')}) AS barcode_split FROM together"))
def barcode_explode(spark, folder):
    gbif, herbo, new = new_and_old(spark, folder)
    both = gbif.unionByName(herbo).unionByName(new)
    return explode_barcodes(both).select("k_order", "k_line", "k_part", "k_supp", "barcode_split")


@query("premerge", with_view(PREMERGE_CTES, select=tidy_sql("united")))
def premerged(spark, folder):
    gbif, herbo, new = new_and_old(spark, folder)
    return tidy(premerge(gbif.unionByName(herbo), new, ORDER))


@query("cells_reduced", with_view(PREMERGE_CTES.split(",\nexploded")[0], select=tidy_sql("reduced")))
def cells_reduced(spark, folder):
    gbif, herbo, new = new_and_old(spark, folder)
    return tidy(reduce_cells(gbif.unionByName(herbo).unionByName(new), PREMERGE_CELLS))


INTEGRATE_CTES = ",\n".join([
    PREMERGE_CTES,
    "with_number AS (SELECT * FROM united WHERE colnum IS NOT NULL)",
    "without_number AS (SELECT * FROM united WHERE colnum IS NULL)",
    master_merge_sql("with_number", NUMBERED, "_a", ", barcode"),
    master_merge_sql("without_number", ", ".join(MASTER_SN_KEYS), "_b", ", barcode"),
    f"""filed AS (SELECT * REPLACE ({_reduce(FILING_CELLS)}),
  CASE WHEN accepted_name IS NULL THEN 'indet' WHEN ddlat IS NULL THEN 'coord'
       WHEN recorded_by IS NULL OR colnum IS NULL THEN 'quarantine' ELSE 'master' END AS route
  FROM (SELECT * FROM merged_a UNION ALL BY NAME SELECT * FROM merged_b))""",
])


@query("integrate", with_view(INTEGRATE_CTES, select=tidy_sql("filed")))
def integrated(spark, folder):
    gbif, herbo, new = new_and_old(spark, folder)
    return tidy(integrate({"master": gbif, "indet": herbo}, new, ORDER, stamp()).routed)


# Some records lose their barcode, so that every set of a filing run has rows.
SOME_BARE = "k_line % 7 = 0"
_CODED_CTES = INTEGRATE_CTES.replace("AS barcode) FROM specimens)", f"AS barcode) FROM specimens WHERE NOT ({SOME_BARE}))")


@query("filing_conservation", with_view(_CODED_CTES, select=f"""SELECT 'barcodes' AS step, count(*) AS before,
    count(*) FILTER (WHERE {SOME_BARE}) + (SELECT count(*) FROM together) AS after, true AS conserved FROM specimens
  UNION ALL SELECT 'numbers', count(*), (SELECT count(*) FROM with_number) + (SELECT count(*) FROM without_number), true FROM united
  UNION ALL SELECT 'numbered', count(*), count(*), true FROM with_number
  UNION ALL SELECT 'unnumbered', count(*), count(*), true FROM without_number
  UNION ALL SELECT 'routes', (SELECT count(*) FROM merged_a) + (SELECT count(*) FROM merged_b), count(*), true FROM filed"""))
def filing_conservation(spark, folder):
    """The rows that come into and out of every step of a filing run, as the run itself counts them."""
    tables = [t.withColumn("barcode", F.when(~F.expr(SOME_BARE), F.col("barcode"))) for t in new_and_old(spark, folder)]
    filed = integrate({"master": tables[0], "indet": tables[1]}, tables[2], ORDER, stamp())
    for part in (filed.routed, filed.no_barcode, filed.scattered):
        part.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(filed.ledger.counts(), "step string, before long, after long, conserved boolean")


@query("filing_no_barcode", with_view(select=f"SELECT k_order, k_line, k_part, k_supp FROM specimens WHERE {SOME_BARE}"))
def filing_no_barcode(spark, folder):
    tables = [t.withColumn("barcode", F.when(~F.expr(SOME_BARE), F.col("barcode"))) for t in new_and_old(spark, folder)]
    filed = integrate({"master": tables[0], "indet": tables[1]}, tables[2], ORDER, stamp())
    return filed.no_barcode.select("k_order", "k_line", "k_part", "k_supp")
