"""Rule tables of the merges: which column is kept, and which is joined."""

from __future__ import annotations

from vasculum.operators.merge import Rule, const, first, join, joined, joined_or_null, last
from vasculum.schema import MASTER_COLUMNS, RAW_COLUMNS

# Columns that are joined in each merge. `ALL` cells join whatever is
# there; `WHOLE` cells become null when one of the records has none.
RAW_ALL = ["det_by", "institute", "herbarium_code", "colnum_full", "orig_bc"]
RAW_WHOLE = ["barcode", "source_id", "link"]

BARCODE_ALL = ["det_by", "institute", "herbarium_code"]
BARCODE_WHOLE = ["orig_bc", "source_id", "link"]

MASTER_ALL = ["det_by", "institute", "herbarium_code", "colnum_full", "geo_issues", "modified"]
MASTER_WHOLE = ["barcode", "orig_bc", "source_id", "link"]

CELLS = [
    "colnum_full", "det_by", "institute", "herbarium_code", "barcode", "orig_bc",
    "link", "geo_issues", "orig_recby", "source_id", "modified",
]

SELF_ALL = ["geo_issues", "modified"]
SELF_WHOLE = [
    "colnum_full", "det_by", "institute", "herbarium_code", "barcode", "orig_bc",
    "orig_recby", "link", "source_id",
]

FINAL_ALL = ["geo_issues", "modified", "orig_bc", "orig_recby"]
FINAL_WHOLE = ["colnum_full", "det_by", "institute", "herbarium_code", "barcode", "link", "source_id"]

# Gathering data, for which the collection's own record is better than an expert's.
GATHERING = [
    "col_date", "col_day", "col_month", "col_year", "country_iso3", "country",
    "continent", "locality", "coordinate_id", "institute", "herbarium_code", "orig_bc",
    "coll_surname", "huh_name", "geo_col", "wiki_url", "link", "orig_recby",
    "geo_issues", "modified",
]
COORDINATES = ["ddlong", "ddlat"]
BY_NUMBER_EXPERT = ["prefix", "colnum", "sufix", "det_date", "det_day", "det_month", "det_year"]
EXPERT_PATCH = ["recorded_by", "det_by", "det_year", "accepted_name", "ipni_no"]
# ------------------------------- end of fixed values


def _table(columns, all_cells=(), whole_cells=(), taken_last=()) -> dict[str, Rule]:
    table = {}
    for c in columns:
        if c in all_cells:
            table[c] = joined(c)
        elif c in whole_cells:
            table[c] = joined_or_null(c)
        elif c in taken_last:
            table[c] = last()
        else:
            table[c] = first()
    return table


def raw_merge() -> dict[str, Rule]:
    """Duplicates within one provider's file."""
    extra = ["orig_bc", "coll_surname"]
    return _table(RAW_COLUMNS + extra, RAW_ALL, RAW_WHOLE)


def barcode_merge(expert: bool) -> dict[str, Rule]:
    """Master records with the same barcode; an expert file also joins the numbers."""
    columns = [c for c in MASTER_COLUMNS if c not in ("orig_recby", "modified", "geo_issues")]
    whole = BARCODE_WHOLE + (["colnum_full"] if expert else [])
    return _table(columns, BARCODE_ALL, whole)


def key_merge() -> dict[str, Rule]:
    """Master records with the same duplicate key."""
    columns = [c for c in MASTER_COLUMNS if c != "orig_recby"]
    return _table(columns, MASTER_ALL, MASTER_WHOLE)


def expert_over_master_merge() -> dict[str, Rule]:
    """The expert record of a key and the other record of it."""
    return key_merge() | {"colnum_full": first()}


def exploded_merge() -> dict[str, Rule]:
    """Records sharing one barcode, or one whole set of barcodes."""
    return _table(MASTER_COLUMNS, CELLS)


def expert_barcode_merge(expert_has_coordinates: bool) -> dict[str, Rule]:
    """Expert first, collection last: names and determination from the expert,
    gathering data from the collection."""
    taken_last = GATHERING + ([] if expert_has_coordinates else COORDINATES)
    table = _table(MASTER_COLUMNS, ["colnum_full", "barcode", "source_id"], taken_last=taken_last)
    return table | {"origin": first()}


def expert_set_merge() -> dict[str, Rule]:
    return exploded_merge() | {"origin": first()}


def expert_patch(with_coordinates: bool) -> dict[str, Rule]:
    """What an expert record changes in the master record of the same number."""
    table = {c: first() for c in EXPERT_PATCH + (COORDINATES if with_coordinates else [])}
    return table | {
        "expert_det": const("EXP"),
        "status": const("ACCEPTED"),
        "barcode": last(),
        "new_barcode": first("barcode"),
    }


def self_merge() -> dict[str, Rule]:
    """Master records with the same collector and number, among themselves."""
    return _table(MASTER_COLUMNS, SELF_ALL, SELF_WHOLE)


def final_merge() -> dict[str, Rule]:
    """Records with the same collector and number in the final cleaning."""
    return _table(MASTER_COLUMNS, FINAL_ALL, FINAL_WHOLE)


def by_number_merge(names: bool, coordinates: bool) -> dict[str, Rule]:
    """Expert first, by collector and number. The expert gives names, coordinates or
    both; everything about the gathering stays the collection's."""
    taken_first = set(BY_NUMBER_EXPERT)
    if names:
        taken_first.add("accepted_name")
    if coordinates:
        taken_first.update(COORDINATES)
    columns = [c for c in MASTER_COLUMNS if c != "modified"]
    cells = ["colnum_full", "det_by", "geo_issues", "orig_recby"]
    if names and coordinates:
        cells.append("source_id")
    table = _table(columns, cells, taken_last=[c for c in columns if c not in taken_first])
    return table | ({"expert_det": const("SMALLEXP")} if names else {})
