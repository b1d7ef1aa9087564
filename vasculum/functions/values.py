"""Dates, coordinates, taxon names and multi-valued cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vasculum.functions.nulls import blank_to_null
from vasculum.schema import NULL_NUMBER

# Epithets that say a specimen is not named to species.
OPEN_NOMENCLATURE = ["sp.", "indet."]


def _part(parts: Column, position: int) -> Column:
    return F.nullif(F.try_element_at(parts, F.lit(position)).try_cast("int"), F.lit(0))


def day_month_year(c: Column, which: str) -> dict[str, Column]:
    """`d/m/y`, or a range `d/m/y-d/m/y` of which the first date counts."""
    parts = F.split(F.split_part(c, F.lit("-"), F.lit(1)), "/")
    return {f"{which}_{unit}": _part(parts, i) for i, unit in enumerate(("day", "month", "year"), 1)}


def iso_date(c: Column, which: str) -> dict[str, Column]:
    """`y-m-d`, with or without a time after `T`."""
    parts = F.split(F.split_part(c, F.lit("T"), F.lit(1)), "-")
    return {f"{which}_{unit}": _part(parts, i) for i, unit in enumerate(("year", "month", "day"), 1)}


def year_month_day(c: Column, which: str) -> dict[str, Column]:
    """`y/m/d` as expert files write it."""
    parts = F.split(c, "/")
    return {f"{which}_{unit}": _part(parts, i) for i, unit in enumerate(("year", "month", "day"), 1)}


def compose_date(year: Column, month: Column, day: Column) -> Column:
    """`y/m/d`, only when all three parts are there."""
    return F.concat(
        year.cast("string"), F.lit("/"), month.cast("string"), F.lit("/"), day.cast("string")
    )


def year_digits(c: Column) -> Column:
    return F.regexp_extract(c.cast("string"), r"(\d+)", 1).try_cast("int")


def degrees(c: Column) -> Column:
    """A coordinate as a number; sentinels and text become null."""
    value = F.trim(c.cast("string")).try_cast("double")
    return F.when(value != NULL_NUMBER, value)


def lat_long_pair(c: Column) -> dict[str, Column]:
    """`"lat, long"` in one cell."""
    parts = F.split(c, ",")
    return {
        "ddlat": degrees(F.try_element_at(parts, F.lit(1))),
        "ddlong": degrees(F.try_element_at(parts, F.lit(2))),
    }


def usable_coordinates(lat: Column, lon: Column) -> dict[str, Column]:
    """A missing half, or exactly (0, 0), is no coordinate."""
    good = lat.isNotNull() & lon.isNotNull() & ((lat != 0) | (lon != 0))
    return {"ddlat": F.when(good, lat), "ddlong": F.when(good, lon)}


def genus_and_epithet(c: Column) -> dict[str, Column]:
    parts = F.split(c, " ", 2)
    return {
        "genus": blank_to_null(F.try_element_at(parts, F.lit(1))),
        "specific_epithet": blank_to_null(F.try_element_at(parts, F.lit(2))),
    }


def strip_open_nomenclature(c: Column) -> Column:
    tokens = F.filter(F.split(c, " "), lambda t: ~t.isin(OPEN_NOMENCLATURE))
    return blank_to_null(F.array_join(tokens, " "))


def taxon_key(genus: Column, epithet: Column) -> Column:
    return F.concat(genus, F.lit(" "), epithet)


def tokens_of(cell: Column, sep: str) -> Column:
    """Distinct values of a cell in order of first appearance."""
    mark = sep.strip()
    pieces = F.split(cell, r"\s+-\s+" if mark == "-" else rf"\s*{mark}\s+")
    return F.array_distinct(
        F.filter(
            F.transform(pieces, lambda t: F.btrim(F.btrim(t), F.lit(mark + " "))),
            lambda t: (t != "") & (F.lower(t) != "<na>"),
        )
    )


def dedup_cell(cell: Column, sep: str) -> Column:
    """The cell without repeated values. Most cells hold one value; only the others are taken apart."""
    mark = sep.strip()
    one = F.btrim(F.btrim(cell), F.lit(mark + " "))
    single = F.when(F.lower(one) != "<na>", blank_to_null(one))
    return F.when(F.instr(cell, mark) == 0, single).otherwise(blank_to_null(F.array_join(tokens_of(cell, sep), sep)))


def dedup_cells(columns: list[str], separators) -> dict[str, Column]:
    return {c: dedup_cell(F.col(c), separators(c)) for c in columns}
