"""Registry of queries, and helpers shared by the Spark side and the SQL side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from workload.view import SPECIMENS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

NUMBERED = "recorded_by, colnum, sufix, col_year, country_iso3"
GATHERING = "recorded_by, country, col_year, colnum, locality"
TIE = "k_order NULLS FIRST, k_line NULLS FIRST, k_part NULLS FIRST, k_supp NULLS FIRST, k_price NULLS FIRST, k_ship NULLS FIRST"
NEWEST = f"(det_year IS NULL), -det_year, {TIE}"
EXPERT_FIRST = "(CASE WHEN expert_det IS NOT NULL THEN 0 ELSE 1 END)"
STATUS = "(status IS NULL), status"
ROUNDED = ("ddlat", "ddlong")


def query(name: str, sql: str | None = None):
    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(c):
    """Six decimals; the nudge keeps exact halves from depending on summation order."""
    return F.round(c + F.lit(0.00000003), 6)


def tidy(df: DataFrame) -> DataFrame:
    """Drop price and date of the record order, round coordinates."""
    df = df.drop("k_price", "k_ship")
    return df.withColumns({c: rounded(F.col(c)) for c in ROUNDED if c in df.columns})


def tidy_sql(source: str, columns: str = "*", drop: str = "k_price, k_ship") -> str:
    exclude = f" EXCLUDE ({drop})" if columns == "*" else ""
    return (
        f"SELECT {columns}{exclude} REPLACE (round(ddlat + 0.00000003, 6) AS ddlat, "
        f"round(ddlong + 0.00000003, 6) AS ddlong) FROM {source}"
    )


def with_view(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([SPECIMENS_SQL.strip(), *ctes]) + "\n" + select


# --- SQL for one merged column -------------------------------------------------------


def first_sql(c: str, order: str, source: str | None = None) -> str:
    v = source or c
    return f"first({v} ORDER BY {order}) FILTER (WHERE {v} IS NOT NULL) AS {c}"


def last_sql(c: str, order: str, source: str | None = None) -> str:
    v = source or c
    return f"last({v} ORDER BY {order}) FILTER (WHERE {v} IS NOT NULL) AS {c}"


def join_sql(c: str, sep: str, order: str) -> str:
    return f"string_agg({c}, '{sep}' ORDER BY {order}) AS {c}"


def whole_sql(c: str, sep: str, order: str) -> str:
    return f"CASE WHEN count({c}) = count(*) THEN string_agg({c}, '{sep}' ORDER BY {order}) END AS {c}"


def columns_sql(order: str, **kinds) -> str:
    """`first=[…]`, `last=[…]`, `join=[…]`, `whole=[…]` column lists to a SELECT list."""
    sep = {"det_by": " / ", "link": " - "}
    out = []
    for kind, names in kinds.items():
        for c in names:
            if kind == "first":
                out.append(first_sql(c, order))
            elif kind == "last":
                out.append(last_sql(c, order))
            elif kind == "join":
                out.append(join_sql(c, sep.get(c, ", "), order))
            else:
                out.append(whole_sql(c, sep.get(c, ", "), order))
    return ",\n".join(out)


def tokens_sql(cell: str, sep: str = ", ") -> str:
    """Distinct trimmed values of a cell, in order of first appearance."""
    parts = f"list_transform(string_split({cell}, '{sep}'), lambda t: trim(t))"
    return (
        f"list_filter({parts}, lambda t, i: t <> '' AND lower(t) <> '<na>' AND list_position({parts}, t) = i)"
    )


def dedup_sql(cell: str, sep: str = ", ") -> str:
    return f"nullif(array_to_string({tokens_sql(cell, sep)}, '{sep}'), '')"


VIEW_COLUMNS = [
    "source_id", "genus", "specific_epithet", "recorded_by", "prefix", "colnum", "sufix",
    "colnum_full", "col_year", "col_month", "col_day", "det_by", "det_year", "country",
    "country_iso3", "locality", "ddlat", "ddlong", "institute", "herbarium_code", "barcode",
    "orig_bc", "orig_recby", "link", "status", "accepted_name", "ipni_no", "expert_det",
    "geo_issues", "modified",
]
TIE_COLUMNS = ["k_order", "k_line", "k_part", "k_supp", "k_price", "k_ship"]


def rest(*used) -> list[str]:
    taken = {c for names in used for c in names}
    return [c for c in VIEW_COLUMNS if c not in taken]
