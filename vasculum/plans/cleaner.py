"""From a provider's file to cleaned, deduplicated, named records."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from vasculum.functions.barcodes import gbif_barcode, splink_barcode, tropicos_barcode
from vasculum.functions.names import first_collector, standardise_name, surname
from vasculum.functions.numbers import join_colnum, split_colnum
from vasculum.functions.values import day_month_year, genus_and_epithet, iso_date, lat_long_pair
from vasculum.operators.authorities import (
    country_crossfill, resolve_collectors, resolve_expert_taxa, resolve_taxa,
)
from vasculum.operators.dedup import dedup_raw
from vasculum.operators.filters import (
    clear_names_of_indets, expert_defaults, flag_expert, keep_usable_institutes, split_numbered,
)
from vasculum.operators.geo import fill_missing_country, flag_coordinates
from vasculum.operators.groups import materialise
from vasculum.schema import NUMBERED_KEYS, RAW_SN_KEYS
from vasculum.sources.readers import conform_expert, conform_raw

EXTRA = ["record_id", "orig_bc", "country_id"]
ORDER = ["record_id"]


class Cleaned(NamedTuple):
    clean: DataFrame
    quarantine: dict[str, DataFrame]


def clean_columns(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(records in the raw schema, records without usable barcode): numbers, dates,
    barcodes, coordinates and names of taxa, in the way each provider needs."""
    source = "MO_tropicos" if source == "MO" else source
    out = df.withColumn("orig_bc", F.col("barcode"))
    if "country_id" not in df.columns:
        out = out.withColumn("country_id", F.lit(None).cast("string"))
    if source == "BRAHMS":
        out = out.withColumn("colnum_full", join_colnum(F.col("prefix"), F.col("colnum"), F.col("sufix")))
    else:
        out = out.withColumns(split_colnum(F.col("colnum_full"), source))
    if source == "P":
        out = out.withColumns(
            lat_long_pair(F.col("coordinates"))
            | day_month_year(F.col("col_date"), "col")
            | day_month_year(F.col("det_date"), "det")
        )
    elif source == "GBIF":
        out = out.withColumns(
            iso_date(F.col("det_date"), "det")
            | genus_and_epithet(F.col("species-tobesplit"))
            | {"barcode": gbif_barcode(F.col("barcode"), F.col("institute"))}
        )
    elif source == "SPLINK":
        out = out.withColumn(
            "barcode", splink_barcode(F.col("barcode"), F.col("herbarium_code"), F.col("institute"))
        )
    elif source == "MO_tropicos":
        out = out.withColumns(
            {
                "barcode": tropicos_barcode(F.col("barcode")),
                "region": F.concat(F.col("upper-region"), F.col("lower-region")),
            }
        )
    typed = conform_raw(out, EXTRA)
    if source not in ("GBIF", "SPLINK"):
        return typed, typed.filter(F.lit(False))
    return typed.filter(F.col("barcode").isNotNull()), typed.filter(F.col("barcode").isNull())


def standardise_names(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records whose collector could be read, names to check). A determiner that
    cannot be read is listed too, but the record goes on without it."""
    read = df.withColumns(
        {
            "orig_recby": F.col("recorded_by"),
            "orig_detby": F.col("det_by"),
            "recorded_by": standardise_name(first_collector(F.col("recorded_by"))),
            "det_by": standardise_name(F.col("det_by")),
        }
    ).withColumn("coll_surname", surname(F.col("recorded_by")))
    collector_bad = F.col("recorded_by").isNull()
    determiner_bad = F.col("det_by").isNull() & F.col("orig_detby").isNotNull()
    to_check = read.filter(collector_bad | determiner_bad).withColumn(
        "to_check", F.when(collector_bad, "recby_problem").otherwise("detby_problem")
    )
    return read.filter(~collector_bad), to_check


def clean_records(
    df: DataFrame,
    source: str,
    botanists: DataFrame | None = None,
    countries: DataFrame | None = None,
    areas: DataFrame | None = None,
    backbone: DataFrame | None = None,
    expert_file: bool = False,
    corrected: DataFrame | None = None,
) -> Cleaned:
    """The whole cleaning run on a file read with `read_source`. Authority tables that
    are not given are skipped. `corrected`: records with names put right by hand, to
    go on with the others."""
    typed, no_barcode = clean_columns(df, source)
    named, to_check = standardise_names(flag_expert(typed, expert_file))
    if corrected is not None:
        # A record whose determiner could not be read went on already; its corrected form takes its place.
        named = named.join(corrected.select("record_id").distinct(), "record_id", "left_anti").unionByName(corrected, allowMissingColumns=True)
    out = keep_usable_institutes(named)
    if botanists is not None:
        out = resolve_collectors(out, botanists, ORDER)
    if countries is not None:
        out = country_crossfill(out, countries)
        if areas is not None:
            out = fill_missing_country(out, areas, countries)
    out = materialise(out)
    numbered, unnumbered = split_numbered(out)
    keep = [c for c in ("orig_detby", "country_id", "recby_regex") if c in out.columns]
    first = dedup_raw(numbered, NUMBERED_KEYS, ORDER, expert_file, keep)
    second = dedup_raw(unnumbered, RAW_SN_KEYS, ORDER, expert_file, keep)
    clean = first.clean.unionByName(second.clean, allowMissingColumns=True)
    if expert_file:
        clean = expert_defaults(clean)
    elif backbone is not None:
        clean = resolve_taxa(clean, backbone)
    scattered = first.quarantine.unionByName(second.quarantine, allowMissingColumns=True)
    return Cleaned(
        clean,
        {"no_barcode": no_barcode, "names_to_check": to_check, "coordinate_discrepancy": scattered},
    )


def check_coordinates(df: DataFrame, areas: DataFrame, reference: DataFrame, coast: DataFrame) -> DataFrame:
    """The spatial step between cleaning and filing."""
    return clear_names_of_indets(flag_coordinates(df, areas, reference, coast))


def clean_expert(
    expert: DataFrame,
    botanists: DataFrame | None = None,
    backbone: DataFrame | None = None,
    countries: DataFrame | None = None,
    areas: DataFrame | None = None,
) -> DataFrame:
    """The cleaning run of a small expert table read with `read_expert`."""
    out = expert
    if "col_year" not in out.columns:
        out = out.withColumn("col_year", F.lit(None).cast("int"))
    if botanists is not None:
        out = resolve_collectors(out, botanists, ORDER)
    if backbone is not None:
        out = resolve_expert_taxa(out, backbone)
    if countries is not None and ("country" in out.columns or "country_id" in out.columns):
        if "country" not in out.columns:
            out = out.withColumn("country", F.lit(None).cast("string"))
        out = country_crossfill(out, countries)
        if areas is not None and "ddlat" in out.columns:
            out = out.withColumns({c: F.col(c).try_cast("double") for c in ("ddlat", "ddlong")})
            out = fill_missing_country(out, areas, countries)
    return materialise(conform_expert(out, ["record_id"]))
