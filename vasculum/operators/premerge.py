"""Bringing new records and the master table together by barcode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.nulls import text_or_null
from vasculum.functions.values import dedup_cells, tokens_of
from vasculum.operators import rules as R
from vasculum.operators.merge import (
    Rule, ascending_nulls_last, expert_first, first, merge_group, newest_first,
)
from vasculum.schema import DEFAULT_SEPARATOR, NO_BARCODE, PREMERGE_CELLS, separator


def reduce_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop repeated values from multi-valued cells."""
    return df.withColumns(dedup_cells([c for c in columns if c in df.columns], separator))


def barcode_set(cell: Column) -> Column:
    """The barcodes of a cell as a sorted set, so equal sets are equal text."""
    return F.array_join(F.array_sort(tokens_of(cell, DEFAULT_SEPARATOR)), DEFAULT_SEPARATOR)


def explode_barcodes(df: DataFrame, name: str = "barcode_split") -> DataFrame:
    """One row per barcode of the record; records without any stay once."""
    return df.withColumn(name, F.explode_outer(tokens_of(F.col("barcode"), DEFAULT_SEPARATOR)))


def present(df: DataFrame, table: dict[str, Rule], kept: list[str]) -> dict[str, Rule]:
    rules = {c: r for c, r in table.items() if (r.source or c) in df.columns or r.kind == "const"}
    return rules | {c: first() for c in kept if c in df.columns and c not in rules}


def set_fingerprint(codes: Column) -> dict[str, Column]:
    """What tells one set of codes from another, whatever its size: how many there are and two independent 64-bit sums (without
    carry) of their hashes."""

    def total(seed: int) -> Column:
        return F.aggregate(codes, F.lit(0).cast("long"), lambda sum_, code: sum_.bitwiseXOR(F.xxhash64(F.lit(seed), code)))

    return {"_set_size": F.size(codes), "_set_a": total(1), "_set_b": total(2)}


def merge_sets(df: DataFrame, order: list[Column], table: dict[str, Rule], stored: bool = False) -> DataFrame:
    """Merge the records whose barcode cells hold the same set of codes. The key is the set's fingerprint; the cell comes out sorted."""
    codes = F.array_sort(tokens_of(F.col("barcode"), DEFAULT_SEPARATOR))
    keyed = df.withColumn("_codes", codes).withColumns(set_fingerprint(F.col("_codes")))
    keyed = keyed.withColumn("barcode", F.array_join("_codes", DEFAULT_SEPARATOR)).drop("_codes")
    return merge_group(keyed, ["_set_size", "_set_a", "_set_b"], order, table | {"barcode": first()}, stored)


def merge_exploded(df: DataFrame, order: list[Column], table: dict[str, Rule]) -> DataFrame:
    """First all rows that carry the same barcode, then all that ended up with the
    same set of barcodes. One pass: chains of shared barcodes are not followed."""
    single = present(df, table, []) | {"barcode_split": first()}
    by_barcode = merge_group(df, ["barcode_split"], order, single)
    return merge_sets(by_barcode, [*order, F.col("barcode_split")], present(by_barcode, table, []), stored=True)


def premerge(master: DataFrame, new: DataFrame, order: list[str], keep: list[str] = ()) -> DataFrame:
    """Master and new records in one table, merged where they share a barcode."""
    return merge_by_barcode(master.unionByName(new, allowMissingColumns=True), order, keep)


def merge_by_barcode(both: DataFrame, order: list[str], keep: list[str] = ()) -> DataFrame:
    """The records with a barcode, merged where they share one."""
    both = reduce_cells(both.withColumn("barcode", text_or_null(F.col("barcode"))), PREMERGE_CELLS)
    both = both.filter(F.col("barcode").isNotNull() & (F.col("barcode") != NO_BARCODE))
    rank = [
        expert_first(),
        *ascending_nulls_last("status"),
        *newest_first(),
        *map(F.col, order),
    ]
    table = present(both, R.exploded_merge(), [*order, *keep])
    return merge_exploded(explode_barcodes(both), rank, table)
