"""Missing values: sentinels become null at ingest and come back only at the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vasculum.schema import NULL_NUMBER, NULL_TEXT, NULL_TEXT_OF


def bind(c: Column, use) -> Column:
    """`use(c)`, with `c` evaluated once. For long expressions that use a value many
    times: the optimiser would repeat the value's own expression at every place and
    outgrow the limits of generated code."""
    return F.transform(F.array(c), use)[0]


def blank_to_null(c: Column) -> Column:
    """Empty text (what a regular expression yields on no match) to null."""
    return F.nullif(F.trim(c), F.lit(""))


def text_or_null(c: Column, also: list[str] = ()) -> Column:
    """Trimmed text, null when it is one of the sentinels, or of those in `also`."""
    trimmed = F.trim(c)
    missing = [*NULL_TEXT, *also]
    if any("," in text for text in missing):
        return F.when(~trimmed.isin(missing), trimmed)
    # One call instead of a comparison for each: over all columns of a table those make a method too long for Java to compile.
    return F.when(F.find_in_set(trimmed, F.lit(",".join(missing))) == 0, trimmed)


def number_or_null(c: Column, zero_is_null: bool = False) -> Column:
    missing = [NULL_NUMBER, 0] if zero_is_null else [NULL_NUMBER]
    return F.when(~c.isin(missing), c)


def normalise_nulls(
    df: DataFrame, columns: list[str] | None = None, zero_is_null: tuple[str, ...] = ()
) -> DataFrame:
    """Sentinels to null in `columns` (default all). Zero counts as missing only
    where named, since 0 is a valid latitude."""
    fixed = {}
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        if isinstance(field.dataType, T.StringType):
            fixed[field.name] = text_or_null(F.col(field.name), NULL_TEXT_OF.get(field.name, []))
        elif isinstance(field.dataType, T.NumericType):
            fixed[field.name] = number_or_null(F.col(field.name), field.name in zero_is_null)
    return df.withColumns(fixed)


def denormalise_nulls(df: DataFrame, na_value: int = NULL_NUMBER) -> DataFrame:
    """Nulls to the sink's sentinel; `;` in text to `,` because `;` separates fields."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = F.coalesce(F.translate(c, ";", ","), F.lit(str(na_value)))
        elif isinstance(field.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(na_value).cast(field.dataType))
        out.append(c.alias(field.name))
    return df.select(*out)
