"""Reading provider files into the common schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vasculum.functions.names import first_collector, standardise_name
from vasculum.functions.nulls import text_or_null
from vasculum.functions.numbers import split_colnum
from vasculum.functions.values import compose_date, degrees, year_month_day
from vasculum.operators.experts import synthetic_barcodes
from vasculum.operators.groups import materialise
from vasculum.schema import (
    EXPERT_COLUMNS, MASTER_COLUMNS, RAW_COLUMNS, SOURCES, SourceSpec, column_type,
)

#: Equal rows that one task writes out when they are numbered.
COPIES = 10_000


def read_delimited(spark: SparkSession, path: str, separator: str, multiline: bool = True) -> DataFrame:
    """Every column as text, line breaks in quoted cells included. Turn `multiline` off only for
    files without any: those can be split among tasks."""
    return (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .csv(path)
    )


def content_id(columns: list[str], *context: Column) -> Column:
    """128 bits of the cells' text, as 32 characters; null and empty cells differ, and no two ways to cut a text into cells agree."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in [*context, *texts]]
    return F.md5(F.concat_ws("|", *parts))


def number_copies(df: DataFrame, *context: Column) -> DataFrame:
    """Add `record_id`: an id from context and content, and a running number among equal rows; unique, and the same on every run.

    Equal rows cannot be told apart, so it does not matter which of them gets which number. They are counted first, with a combine
    on the map side, and written out again from the counts; a row held more than COPIES times is written by several tasks.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.select(*columns, content_id(df.columns, *context).alias("_id")).groupBy(*columns, "_id").agg(F.count(F.lit(1)).alias("_n"))
    slices = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES))
    few = counted.filter(F.col("_n") <= COPIES).withColumn("_slice", F.lit(0).cast("long"))
    many = counted.filter(F.col("_n") > COPIES).withColumn("_slice", F.explode(slices)).repartition("_id", "_slice")
    first = F.col("_slice") * COPIES + 1
    number = F.explode(F.sequence(first, F.least(first + COPIES - 1, F.col("_n"))))
    return few.unionByName(many).select(*columns, "_id", number.alias("_number")).select(
        *columns, F.concat_ws("-", "_id", F.col("_number").cast("string")).alias("record_id")
    )


def with_record_id(df: DataFrame, source: str) -> DataFrame:
    """The rows of files with a `record_id` from source, file and content."""
    return number_copies(df, F.lit(source), F.col("_metadata.file_name"))


def standardise_columns(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Filter, rename and prune a provider's columns, and say where they come from."""
    missing = [c for c in spec.columns if c not in df.columns and c not in spec.fallback]
    if missing:
        raise ValueError(f"columns missing from the {spec.source_id} file: {', '.join(missing)}")
    for column, value in spec.require.items():
        df = df.filter(F.col(column) == value)

    def value_of(column: str) -> Column:
        tried = [c for c in [column, *spec.fallback.get(column, [])] if c in df.columns]
        return F.coalesce(*[text_or_null(F.col(f"`{c}`")) for c in tried]) if tried else F.lit(None).cast("string")

    extra = [F.col("record_id")] if "record_id" in df.columns else []
    return df.select(
        *[value_of(column).alias(name) for column, name in spec.columns.items()],
        F.lit(spec.source_id).alias("source_id"),
        *extra,
    )


def read_source(spark: SparkSession, path: str, source: str, multiline: bool = True) -> DataFrame:
    """A provider's file with standard column names; all text, sentinels null."""
    if source not in SOURCES:
        raise ValueError(f"unknown source {source}; known are {', '.join(SOURCES)}")
    spec = SOURCES[source]
    raw = read_delimited(spark, path, spec.separator, multiline)
    return standardise_columns(with_record_id(raw, spec.source_id), spec)


def conform(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly these columns with their declared types; absent ones null, values that
    are not of the type null."""
    out = []
    for name in columns:
        kind = column_type(name)
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name)
        if name in ("ddlat", "ddlong"):
            value = degrees(value)
        elif kind.typeName() == "integer":
            # Files written by floating-point tools say 1998.0.
            value = F.nullif(value.cast("string").try_cast("double").try_cast("int"), F.lit(0))
            value = F.when(value > 0, value)
        else:
            value = value.cast("string")
        out.append(value.alias(name))
    return df.select(*out, *[c for c in keep if c in df.columns and c not in columns])


def conform_raw(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    return conform(df, RAW_COLUMNS, keep)


def conform_master(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    return conform(df, MASTER_COLUMNS, keep)


def expert_columns(df: DataFrame) -> DataFrame:
    """Derived columns of an expert table: number parts, dates, collector, determiner."""
    df = df.withColumns({c: text_or_null(F.col(c)) for c in df.columns if c != "record_id"})
    out = df.withColumn("source_id", F.lit("specialist")).withColumns(
        split_colnum(F.col("colnum_full"), "expert") | year_month_day(F.col("det_date"), "det")
    )
    if "col_year" in df.columns:
        out = out.withColumn("col_date", compose_date(F.col("col_year"), F.col("col_month"), F.col("col_day")))
    elif "col_date" in df.columns:
        out = out.withColumns(year_month_day(F.col("col_date"), "col"))
    return out.withColumns(
        {
            "orig_recby": F.col("recorded_by"),
            "orig_detby": F.col("det_by"),
            "recorded_by": standardise_name(first_collector(F.col("recorded_by"), junior="")),
            "det_by": standardise_name(F.col("det_by")),
        }
    )


def read_expert(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(expert records, records whose collector's name could not be read). Records
    without a barcode get one made from the determiner's name and a number."""
    raw = with_record_id(read_delimited(spark, path, ";"), "specialist")
    if "barcode" not in raw.columns:
        raw = raw.withColumn("barcode", F.lit(None).cast("string"))
    # Both outputs, and all that follows, start from this.
    derived = materialise(expert_columns(raw))
    good = derived.filter(F.col("recorded_by").isNotNull())
    bad = derived.filter(F.col("recorded_by").isNull())
    return synthetic_barcodes(good, ["record_id"]), bad


def conform_expert(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The expert schema: what the file lacks altogether (such as coordinates) stays out."""
    return conform(df, [c for c in EXPERT_COLUMNS if c in df.columns], keep)
