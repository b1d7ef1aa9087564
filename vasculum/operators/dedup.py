"""Deduplication: find records of one specimen, reconcile them, merge them."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.values import degrees, strip_open_nomenclature
from vasculum.operators import rules as R
from vasculum.operators.filters import clear_surname_prefix
from vasculum.operators.groups import Parts, attach, crossfill, together, with_group_values
from vasculum.operators.merge import (
    Rule, ascending_nulls_last, expert_first, first, mean, merge_group,
    newest_first, size, variance,
)
from vasculum.schema import COORDINATE_VARIANCE, GATHERING_KEYS

COORDINATES = ["ddlat", "ddlong"]


class Deduplicated(NamedTuple):
    """Merged records; groups whose coordinates disagree (left unmerged), found when they are asked for."""

    clean: DataFrame
    scattered: Callable[[], DataFrame]

    @property
    def quarantine(self) -> DataFrame:
        return self.scattered()


def _reconcile(df: DataFrame, keys: list[str], order: list[str], masked: bool) -> DataFrame:
    """Add the size of each row's duplicate group (`_n`, unless it is there) and copy missing coordinates
    between duplicates of one gathering. With `masked`, a coordinate flagged in
    `geo_issues` is used only when no duplicate has a better one."""
    out = df if "_n" in df.columns else with_group_values(df, keys, {"_n": F.count(F.lit(1))})
    usable = F.col("_n") > 1
    if masked:
        usable &= F.col("geo_issues").isNull()
    # Rows outside duplicate groups neither give nor take coordinates.
    out = out.withColumns({"_f_" + c: F.when(usable, F.col(c)) for c in COORDINATES}).withColumn(
        "_dup", F.col("_n") > 1
    )
    names = ["_f_" + c for c in COORDINATES]
    out = crossfill(out, [*GATHERING_KEYS, "_dup"], names, order)
    return out.withColumns(
        {c: F.coalesce(F.when(F.col("_dup"), F.col("_f_" + c)), F.col(c)) for c in COORDINATES}
    ).drop("_dup", *names)


def _agrees(prefix: str = "_var_") -> Column:
    """Coordinates of the group are close, or too few to tell."""
    near = [F.coalesce(F.col(prefix + c) <= COORDINATE_VARIANCE, F.lit(True)) for c in COORDINATES]
    return near[0] & near[1]


def _deduplicate(
    df: DataFrame, keys: list[str], order: list[str], table: dict[str, Rule],
    merge_order: list[Column], masked: bool, lookup: dict[str, Column] | None = None,
) -> Deduplicated:
    """In parts, if rows come from large files: those that meet in a group or a gathering have what both keys share in common."""
    columns = [c for c in df.columns if c != "_n"]
    shared = [k for k in keys if k in GATHERING_KEYS]
    done = [
        _merged(rows, keys, order, table, merge_order, masked, lookup, columns)
        for rows in (Parts(df, shared).each() if shared else [df])
    ]
    return Deduplicated(together([d.clean for d in done]), lambda: together([d.quarantine for d in done]))


def _merged(
    df: DataFrame, keys: list[str], order: list[str], table: dict[str, Rule], merge_order: list[Column], masked: bool,
    lookup: dict[str, Column] | None, columns: list[str],
) -> Deduplicated:
    ready = _reconcile(df, keys, order, masked)
    if lookup:
        ready = ready.withColumns(lookup)
    spread = {"_var_" + c: variance(c) for c in COORDINATES}
    named = {"_key_" + k: first(k) for k in keys}
    merged = merge_group(ready, keys, merge_order, table | spread | named)
    apart = merged.filter(~_agrees()).select(*[F.col("_key_" + k).alias(k) for k in keys])

    def scattered() -> DataFrame:
        parts, found = Parts(ready.select(*columns), keys), []
        theirs = Parts(apart, keys, number=parts.number if parts.many else 1)
        for rows, those in zip(parts.each(every=True), theirs.each(every=True), strict=True):
            found.append(parts.written(attach(rows, those, keys, "left_semi")))
        return together(found)

    return Deduplicated(merged.filter(_agrees()).drop(*spread, *named), scattered)


def _other_columns(df: DataFrame, keys: list[str], table: dict[str, Rule], kept: list[str]) -> dict[str, Rule]:
    """Rules for the columns `df` really has; others are kept as first value."""
    present = {c: r for c, r in table.items() if c in df.columns}
    return present | {c: first() for c in kept if c in df.columns and c not in present}


def dedup_raw(
    df: DataFrame, keys: list[str], order: list[str], expert_file: bool = False, keep: list[str] = ()
) -> Deduplicated:
    """Merge the duplicates of one provider's file.

    Prefixes equal to the surname are cleared; coordinates are copied between the
    duplicates of a gathering; groups whose coordinates vary by more than
    COORDINATE_VARIANCE go to quarantine, others get the mean; the newest
    determination names the specimen. An expert file's coordinates are not touched.
    `order` is the total order of records (first column numeric).
    """
    df = clear_surname_prefix(df).withColumns({c: degrees(F.col(c)) for c in COORDINATES})
    newest = [*newest_first(), *map(F.col, order)]
    flagged = [expert_first()] if "expert_det" in df.columns else []
    table = _other_columns(df, keys, R.raw_merge(), ["expert_det", "orig_recby", *order, *keep])
    table["genus"] = first("_genus", newest)
    table["specific_epithet"] = first("_epithet", newest)
    epithet = F.col("specific_epithet")
    stripped = strip_open_nomenclature(epithet)
    if expert_file:
        # The size of a group is known when it is merged.
        named = df.withColumns({"_genus": F.col("genus"), "_epithet": stripped})
        whole = {"_whole": first("specific_epithet", newest), "_n": size()}
        merged = merge_group(named, keys, flagged + newest, table | whole)
        merged = merged.withColumn("specific_epithet", F.when(F.col("_n") > 1, F.col("specific_epithet")).otherwise(F.col("_whole")))
        return Deduplicated(merged.drop(*whole), lambda: df.limit(0))
    table |= {c: mean() for c in COORDINATES}
    names = {"_genus": F.col("genus"), "_epithet": F.when(F.col("_n") > 1, stripped).otherwise(epithet)}
    return _deduplicate(df, keys, order, table, flagged + newest, False, names)


def dedup_master(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    stamp: Column,
    expert: bool = False,
    unique_barcodes: bool = False,
    keep: list[str] = (),
    sizes: str | None = None,
    stored: bool = False,
) -> Deduplicated:
    """Merge the duplicates of the master table; every record gets the run stamp.

    Records sharing a barcode cell are merged first (skip with `unique_barcodes`).
    In an expert run the expert's word comes first and coordinates stay as given.
    Otherwise flagged coordinates are replaced by a duplicate's, groups that disagree
    go to quarantine and the newest determination names the specimen.
    A column `_n`, if there is one, holds the size of each row's group by `keys`; with `unique_barcodes` only.
    With `sizes`, a column of that name says how many records each merged one stands for (of the last merge; not in an expert run).
    `stored` rows are read from files and changed row by row at most.
    """
    df = clear_surname_prefix(df)
    newest = [*newest_first(), *map(F.col, order)]
    expert_then_newest = [expert_first(), *newest]
    kept = [*order, *keep]
    if not unique_barcodes:
        table = _other_columns(df, ["barcode"], R.barcode_merge(expert), [*kept, "orig_recby", "modified", "geo_issues"])
        df = merge_group(df, ["barcode"], expert_then_newest, table, stored)
    df = df.withColumns({c: degrees(F.col(c)) for c in COORDINATES})
    named = ["accepted_name", "genus", "specific_epithet", "status", "ipni_no"]
    kept_table = _other_columns(df, keys, R.key_merge(), ["orig_recby", *kept])

    if not expert:
        table = kept_table | {c: first(order=newest) for c in named if c in kept_table}
        table |= {c: mean() for c in COORDINATES} | ({sizes: size()} if sizes else {})
        done = _deduplicate(df, keys, order, table, expert_then_newest, True)
        return Deduplicated(done.clean.withColumn("modified", stamp), done.scattered)

    # Experts among themselves and the others among themselves, then both together.
    by_status = [*ascending_nulls_last("status"), *newest]
    df = df.withColumn("_expert", F.col("expert_det").isNotNull())
    parts, merged = Parts(df, keys), []
    for rows in parts.each():
        sided = merge_group(rows, [*keys, "_expert"], by_status, kept_table | {"_expert": first()}, stored=parts.many, short=parts.short)
        both = _other_columns(sided, keys, R.expert_over_master_merge(), ["orig_recby", *kept])
        merged.append(merge_group(sided, keys, [~F.col("_expert"), *map(F.col, order)], both, stored=True))
    return Deduplicated(together(merged).withColumn("modified", stamp), lambda: df.drop("_expert").limit(0))


def diverging_identifications(df: DataFrame, name_columns: list[str]) -> DataFrame:
    """How many records share year, number and country with another record, but not
    collector, number and name: duplicates somebody named differently."""
    place = ["col_year", "colnum_full", "country"]
    named = ["recorded_by", "colnum_full", *name_columns]
    every = list(dict.fromkeys(place + named))
    # Counting distinct combinations first keeps hot values small from here on.
    combos = df.groupBy(*every).agg(F.count(F.lit(1)).alias("_rows"))
    out = with_group_values(combos, place, {"_place": F.sum("_rows")})
    out = with_group_values(out, named, {"_named": F.sum("_rows")})
    hits = F.when((F.col("_place") > 1) & (F.col("_named") == 1), F.col("_rows")).otherwise(0)
    return out.agg(F.coalesce(F.sum(hits), F.lit(0)).alias("diverging_records"))
