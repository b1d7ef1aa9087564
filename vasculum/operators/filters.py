"""Row-level steps: provenance, block list, routing, required fields, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.names import surname
from vasculum.functions.nulls import blank_to_null
from vasculum.functions.values import taxon_key
from vasculum.schema import BLOCKED_INSTITUTES


def keep_usable_institutes(df: DataFrame, blocked: list[str] = BLOCKED_INSTITUTES) -> DataFrame:
    """Drop records of blocked institutions; an unknown institution stays."""
    return df.filter(~F.coalesce(F.col("institute").isin(blocked), F.lit(False)))


def split_numbered(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with a collection number, records without: *s.n.*)."""
    return df.filter(F.col("colnum").isNotNull()), df.filter(F.col("colnum").isNull())


def has_collector_and_number() -> Column:
    return F.col("recorded_by").isNotNull() & F.col("colnum").isNotNull()


def split_usable_key(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that can be matched by collector and number, the others)."""
    return df.filter(has_collector_and_number()), df.filter(~has_collector_and_number())


def with_route(df: DataFrame) -> DataFrame:
    """Where a record is filed: no name, no coordinate, no key, or the master table."""
    return df.withColumn(
        "route",
        F.when(F.col("accepted_name").isNull(), "indet")
        .when(F.col("ddlat").isNull(), "coord")
        .when(~has_collector_and_number(), "quarantine")
        .otherwise("master"),
    )


def clear_surname_prefix(df: DataFrame) -> DataFrame:
    """A prefix that only repeats the collector's surname is no prefix."""
    repeats = F.col("prefix").eqNullSafe(surname(F.col("recorded_by")))
    return df.withColumn("prefix", F.when(~repeats, F.col("prefix")))


def clear_names_of_indets(df: DataFrame) -> DataFrame:
    """Without an epithet there is no accepted name, status or expert opinion."""
    named = F.col("specific_epithet").isNotNull()
    return df.withColumns(
        {c: F.when(named, F.col(c)) for c in ("accepted_name", "status", "expert_det")}
    )


def drop_artefacts(df: DataFrame) -> DataFrame:
    """Drop rows that hold one and the same value in every filled cell.

    The row id makes the condition one that the optimiser leaves where it is: it would
    otherwise rewrite a condition over all columns for every combination of the columns
    derived from them later, which takes for ever.
    """
    cells = [F.col(c).cast("string") for c in df.columns]
    varied = ~F.coalesce(F.least(*cells) == F.greatest(*cells), F.lit(False))
    return df.filter(F.when(F.monotonically_increasing_id() >= 0, varied))


def flag_expert(df: DataFrame, expert_file: bool) -> DataFrame:
    flag = F.lit("expert_det_file") if expert_file else F.lit(None).cast("string")
    return df.withColumn("expert_det", flag)


def expert_defaults(df: DataFrame) -> DataFrame:
    """An expert file is taken at its word: its names are the accepted ones."""
    return df.withColumns(
        {
            "status": F.lit("ACCEPTED"),
            "accepted_name": taxon_key(F.col("genus"), F.col("specific_epithet")),
        }
    )


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job when a required value is missing, checked while the rows stream by."""
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    message = F.concat(F.lit("expert record lacks: "), missing)
    # A filter is not pruned with unread columns, so the check runs even under a count.
    return df.filter(F.when(blank_to_null(missing).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def count_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows lack each required value: one row, one aggregate."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
