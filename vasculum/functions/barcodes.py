"""Specimen barcodes: one code per sheet, herbarium acronym first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from vasculum.functions.nulls import bind, blank_to_null
from vasculum.schema import DEFAULT_SEPARATOR

# Forms of the code itself, forms of the acronym before it, both in
# order of preference, and codes that need translation.
CODE_FORMS = [
    r"^\w+$",
    r"\d+\-\d+\/\d+$",
    r"\d+\:\d+\:\d+$",
    r"\d+\-\d+$",
    r"\d+\/\d+$",
    r"\d+\.\d+$",
    r"\d+\s\d+$",
    r"\d+$",
]
ACRONYM_FORMS = [
    r"^[A-Z]+\-[A-Z]+\-",
    r"^[A-Z]+\s[A-Z]+",
    r"^[A-Z]+\-",
    r"^[A-Z]+",
]
EMPTY_CODE = r"^[A-Z]+0$"
ACRONYM_CORRECTIONS = {"PLANT": "TAIF"}
CAPITALISED_WORD = r"^[A-Z][a-z]+.+$"


def _leading_capitals(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, r"^([A-Z]+)", 1))


def acronym_of_institute(institute: Column) -> Column:
    """Leading capitals, unless the cell is written out in words."""
    return F.when(~institute.rlike("[a-z]"), _leading_capitals(institute))


def standard_barcode(
    barcode: Column, fallbacks: list[Column], zero_is_missing: bool
) -> Column:
    """Acronym and code. `fallbacks` are tried in turn for the acronym when the
    barcode has none; null means the record has no usable barcode."""
    def assemble(text: Column) -> Column:
        own = [F.regexp_extract(text, f"({form})", 1) for form in ACRONYM_FORMS]
        # No match is empty text: the first that is not empty counts.
        acronym = F.lit("")
        for candidate in reversed([*own, *[F.coalesce(f, F.lit("")) for f in fallbacks]]):
            acronym = F.when(candidate != "", candidate).otherwise(acronym)
        code = F.regexp_extract(text, "(?U)(" + "|".join(CODE_FORMS) + ")", 1)
        return F.struct(F.trim(code).alias("code"), F.trim(acronym).alias("acronym"))

    def complete(parts: Column) -> Column:
        code, acronym = parts["code"], parts["acronym"]
        for written, meant in ACRONYM_CORRECTIONS.items():
            acronym = F.when(acronym == written, F.lit(meant)).otherwise(acronym)
        full = F.when(code.rlike("[A-Z]"), code).otherwise(F.concat(acronym, code))
        missing = (code == "") | (full.rlike(EMPTY_CODE) if zero_is_missing else F.lit(False))
        return F.when(~missing, full)

    return bind(bind(barcode, assemble), complete)


def gbif_barcode(barcode: Column, institute: Column) -> Column:
    return standard_barcode(barcode, [acronym_of_institute(institute)], True)


def splink_barcode(barcode: Column, herbarium_code: Column, institute: Column) -> Column:
    return standard_barcode(
        barcode, [_leading_capitals(herbarium_code), _leading_capitals(institute)], False
    )


def tropicos_barcode(specimen_id: Column) -> Column:
    return F.concat(F.lit("MO"), specimen_id)


def _of_one_or_many(cell: Column, keep: Column, many: Callable[[Column], Column]) -> Column:
    """The cell of one value if `keep` holds, or what `many` makes of several: most cells hold one and need not be taken apart."""
    one = F.when(keep, blank_to_null(cell))
    return F.when(F.instr(cell, DEFAULT_SEPARATOR) == 0, one).when(cell.isNotNull(), many(cell))


def tidy_barcode_cell(cell: Column) -> Column:
    """Drop bare numbers that another code in the cell already ends with, and empty
    codes such as `K0`."""

    def tidy(tokens: Column) -> Column:
        kept = F.filter(
            tokens,
            lambda t: ~t.rlike(EMPTY_CODE)
            & ~(t.rlike(r"^\d+$") & F.exists(tokens, lambda o: (o != t) & o.endswith(t))),
        )
        return F.array_join(kept, DEFAULT_SEPARATOR)

    return _of_one_or_many(cell, ~cell.rlike(EMPTY_CODE), lambda many: bind(bind(F.split(many, DEFAULT_SEPARATOR), tidy), blank_to_null))


def has_bare_number(cell: Column) -> Column:
    """Some code in the cell still starts with a digit."""
    return F.coalesce(
        F.exists(F.split(cell, DEFAULT_SEPARATOR), lambda t: t.rlike(r"^\d")), F.lit(False)
    )


def code_tokens(cell: Column) -> Column:
    """Only the code-like values of an institute or herbarium cell."""

    def kept(many: Column) -> Column:
        codes = F.filter(F.split(many, DEFAULT_SEPARATOR), lambda t: ~t.rlike(CAPITALISED_WORD))
        return bind(F.array_join(codes, DEFAULT_SEPARATOR), blank_to_null)

    return _of_one_or_many(cell, ~cell.rlike(CAPITALISED_WORD), kept)
