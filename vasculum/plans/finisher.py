"""The final cleaning of a master table, before it is handed out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from vasculum.functions.barcodes import code_tokens, has_bare_number, tidy_barcode_cell
from vasculum.functions.nulls import bind, normalise_nulls
from vasculum.operators import rules as R
from vasculum.operators.filters import clear_surname_prefix, split_usable_key
from vasculum.operators.groups import materialise
from vasculum.operators.merge import ascending_nulls_last, expert_first, merge_group, newest_first
from vasculum.operators.premerge import present
from vasculum.schema import EXPERT_KEYS, NO_BARCODE
from vasculum.sources.tables import apply_corrections


class Finished(NamedTuple):
    """The cleaned table; its records (as they were before merging) with a barcode that still begins with a digit, to be corrected by hand."""

    clean: DataFrame
    to_check: DataFrame


def tidy_codes(df: DataFrame) -> DataFrame:
    """Barcode cells without doubled and empty codes; institute and herbarium cells without words that are no codes."""
    return df.withColumns(
        {
            "barcode": bind(F.col("barcode"), lambda cell: F.nullif(tidy_barcode_cell(cell), F.lit(NO_BARCODE))),
            "herbarium_code": bind(F.col("herbarium_code"), code_tokens),
            "institute": bind(F.col("institute"), code_tokens),
        }
    )


def finish(
    df: DataFrame, order: list[str], corrected: DataFrame | None = None, key: str = "record_id", keep: list[str] = ()
) -> Finished:
    """Tidy codes, clear prefixes that repeat the surname, and merge the records of one collector and number.

    An expert's record ranks first, then the newest determination, then the name, then `order`, which must be total. Records without collector or
    number stay as they are. `corrected` holds barcodes put right by hand, by `key`: they replace those of the table first.
    """
    # Written once, for the merge, the records that stay as they are, and those to check.
    tidy = materialise(tidy_codes(clear_surname_prefix(normalise_nulls(df))))
    bare = F.coalesce(has_bare_number(F.col("barcode")), F.lit(False))
    if corrected is not None:
        fixed, left = apply_corrections(tidy.filter(bare), corrected, ["barcode"], key)
        tidy = tidy.filter(~bare).unionByName(fixed).unionByName(left)
    usable, others = split_usable_key(tidy)
    rank = [expert_first(), *newest_first(), *ascending_nulls_last("accepted_name"), *map(F.col, order)]
    merged = merge_group(usable, EXPERT_KEYS, rank, present(usable, R.final_merge(), [*order, *keep]), stored=corrected is None)
    return Finished(merged.unionByName(others.select(*merged.columns)), tidy.filter(bare))
