"""Collection numbers: prefix, core number and suffix of a label number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vasculum.functions.nulls import blank_to_null

# What counts as prefix, suffix and number on a label.
PREFIX = r"^([a-zA-Z]*)"
SUFFIX_LETTERS = r"[a-zA-Z]*$"
SUFFIX_LETTERS_SPACES = r"[a-zA-Z ]*$"
SUFFIX_SERIES = [r"SR_\d{1,}", r"R_\d{1,}"]
SUFFIX_LETTER_DIGITS = r"[a-zA-Z ]*\d+([a-zA-Z]\d+)$"
SUFFIX_AFTER_DIGITS = r"[a-zA-Z ]*\d+([a-zA-Z]+)$"
SLASHED = r"\d+/\d+"
THREE_HYPHENED = r"\d+\-\d+\-\d+"
TWO_HYPHENED = r"\d+\-\d+"
THREE_SPACED = r"\d+\s\d+\s\d+"
DECIMAL = r"\d+\.\d+"
PLAIN = r"\d+"

# Number forms tried in this order, by provider.
CORE_FORMS = {
    "P": [SLASHED, THREE_HYPHENED, TWO_HYPHENED, THREE_SPACED, DECIMAL, PLAIN],
    "RAINBIO": [SLASHED, THREE_HYPHENED, TWO_HYPHENED, THREE_SPACED, DECIMAL, PLAIN],
    "GBIF": [SLASHED, THREE_HYPHENED, TWO_HYPHENED, DECIMAL, PLAIN],
    "MO_tropicos": [SLASHED, THREE_HYPHENED, TWO_HYPHENED, DECIMAL, PLAIN],
    "SPLINK": [SLASHED, THREE_HYPHENED, TWO_HYPHENED, DECIMAL, PLAIN],
    "expert": [SLASHED, THREE_HYPHENED, THREE_SPACED, DECIMAL, PLAIN],
}


def _alternatives(forms: list[str]) -> str:
    return "(" + "|".join(forms) + ")"


def colnum_prefix(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, PREFIX, 1))


def colnum_suffix(c: Column, source: str) -> Column:
    if source == "RAINBIO":
        return F.coalesce(
            blank_to_null(F.regexp_extract(c, SUFFIX_LETTER_DIGITS, 1)),
            blank_to_null(F.regexp_extract(c, SUFFIX_AFTER_DIGITS, 1)),
        )
    letters = SUFFIX_LETTERS if source == "GBIF" else SUFFIX_LETTERS_SPACES
    return blank_to_null(F.regexp_extract(c, _alternatives([letters, *SUFFIX_SERIES]), 1))


def colnum_core(c: Column, source: str) -> Column:
    return blank_to_null(F.regexp_extract(c, _alternatives(CORE_FORMS[source]), 1))


def split_colnum(c: Column, source: str) -> dict[str, Column]:
    return {
        "prefix": colnum_prefix(c),
        "colnum": colnum_core(c, source),
        "sufix": colnum_suffix(c, source),
    }


def join_colnum(prefix: Column, colnum: Column, sufix: Column) -> Column:
    """The label number put together again; null when all parts are missing."""
    return blank_to_null(F.concat_ws("", prefix, colnum, sufix))
