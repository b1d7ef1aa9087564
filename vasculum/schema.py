"""Table schemas, provider specifications and sentinel values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names, provider columns, constants and sentinels that
# existing data files carry and every reader and writer must agree on.
# --------------------------------------------------------------------------

RAW_COLUMNS = [
    "source_id", "scientific_name", "genus", "specific_epithet", "species_author",
    "collector_id", "recorded_by", "prefix", "colnum", "sufix", "colnum_full",
    "col_date", "col_day", "col_month", "col_year",
    "det_by", "det_date", "det_day", "det_month", "det_year",
    "country_iso3", "country", "continent", "locality", "coordinate_id",
    "ddlong", "ddlat", "institute", "herbarium_code", "barcode",
    "huh_name", "geo_col", "wiki_url", "link",
]

MASTER_COLUMNS = [
    "source_id", "scientific_name", "genus", "specific_epithet", "species_author",
    "collector_id", "recorded_by", "colnum_full", "prefix", "colnum", "sufix",
    "col_date", "col_day", "col_month", "col_year",
    "det_by", "det_date", "det_day", "det_month", "det_year",
    "country_iso3", "country", "continent", "locality", "coordinate_id",
    "ddlong", "ddlat", "institute", "herbarium_code", "barcode", "orig_bc",
    "coll_surname", "orig_recby", "status", "accepted_name", "ipni_no",
    "huh_name", "geo_col", "wiki_url", "expert_det", "ipni_species_author",
    "modified", "geo_issues", "link",
]

EXPERT_COLUMNS = [
    "source_id", "genus", "specific_epithet", "recorded_by", "colnum_full",
    "prefix", "colnum", "sufix", "det_by", "det_date", "det_day", "det_month",
    "det_year", "country_iso3", "locality", "ddlong", "ddlat", "barcode",
    "accepted_name", "ipni_no",
]

EXPERT_MIN_COLUMNS = [
    "source_id", "genus", "specific_epithet", "recorded_by", "colnum_full",
    "prefix", "colnum", "sufix", "det_by", "det_date", "det_day", "det_month",
    "det_year", "accepted_name", "ipni_no",
]

INTEGER_COLUMNS = {"col_day", "col_month", "col_year", "det_day", "det_month", "det_year"}
DOUBLE_COLUMNS = {"ddlat", "ddlong"}

# Text that stands for "no value" in the files.
NULL_TEXT = ["", "-9999", "nan", "NaN", "None", "<NA>"]
# Those of single columns.
NULL_TEXT_OF = {"geo_issues": ["NONE"], "country": ["not found"]}
NULL_NUMBER = -9999
NO_BARCODE = "no_Barcode"

# Cells that hold several values, and what separates them.
DEFAULT_SEPARATOR = ", "
CELL_SEPARATORS = {"det_by": " / ", "link": " - "}

# Cells whose repeated values are reduced before barcode matching, and after filing.
PREMERGE_CELLS = [
    "source_id", "colnum_full", "institute", "herbarium_code", "geo_issues",
    "barcode", "det_by", "link", "orig_recby",
]
FILING_CELLS = [
    "source_id", "colnum_full", "institute", "herbarium_code", "orig_bc",
    "geo_issues", "det_by", "link", "orig_recby", "modified", "barcode",
]

# Institutions whose records cannot be used.
BLOCKED_INSTITUTES = ["AU", "AAU"]

# Keys by which two records are taken to be duplicates.
NUMBERED_KEYS = ["recorded_by", "colnum", "sufix", "col_year", "country_iso3"]
RAW_SN_KEYS = [
    "recorded_by", "col_year", "col_month", "col_day",
    "genus", "specific_epithet", "country_iso3", "locality",
]
MASTER_SN_KEYS = [
    "recorded_by", "col_year", "col_month", "col_day", "accepted_name", "country_iso3",
]
EXPERT_KEYS = ["recorded_by", "prefix", "colnum", "sufix"]
# Records of one gathering, between which coordinates may be copied.
GATHERING_KEYS = ["recorded_by", "country", "col_year", "colnum", "locality"]

# Coordinates of duplicates may vary by this much (sample variance, degrees squared).
COORDINATE_VARIANCE = 0.1

HERBONAUTES_COLUMNS = {
    "specimen...code": "barcode",
    "collector...collector": "recorded_by",
    "collect_number...number": "colnum_full",
    "identifier...identifier": "det_by",
    "Date.deter...collect_date": "det_date",
    "collect_date...collect_date": "col_date",
    "country...country": "country",
    "region1...region": "region",
    "locality...locality": "locality",
    "geo...position": "coordinates",
    "specimen...genus": "genus",
    "specimen...specific_epithet": "specific_epithet",
}

DARWIN_CORE_COLUMNS = {
    "scientificName": "scientific_name",
    "genus": "genus",
    "species": "species-tobesplit",
    "countryCode": "country_id",
    "locality": "locality",
    "decimalLatitude": "ddlat",
    "decimalLongitude": "ddlong",
    "recordedBy": "recorded_by",
    "recordNumber": "colnum_full",
    "day": "col_day",
    "month": "col_month",
    "year": "col_year",
    "identifiedBy": "det_by",
    "dateIdentified": "det_date",
    "institutionCode": "institute",
    "collectionCode": "herbarium_code",
    "catalogNumber": "barcode",
    "references": "link",
}

BRAHMS_COLUMNS = {
    "GENUS": "genus",
    "SP1": "specific_epithet",
    "COUNTRY": "country",
    "MAJORAREA": "region",
    "LOCNOTES": "locality",
    "LATDEC": "ddlat",
    "LONGDEC": "ddlong",
    "DAY": "col_day",
    "MONTH": "col_month",
    "YEAR": "col_year",
    "DETDAY": "det_day",
    "DETMONTH": "det_month",
    "DETYEAR": "det_year",
    "BARCODE": "barcode",
    "PREFIX": "prefix",
    "SUFFIX": "sufix",
    "NUMBER": "colnum",
    "DETBY": "det_by",
    "COLLECTOR": "recorded_by",
    "IMAGELIST": "link",
}

TROPICOS_COLUMNS = {
    "SpecimenID": "barcode",
    "DeterminationFullNameNoAuthors": "scientific_name",
    "genus": "genus",
    "specific_epithet": "specific_epithet",
    "UpperName": "upper-region",
    "LowerName": "lower-region",
    "SeniorCollector": "recorded_by",
    "CollectionNumber": "colnum_full",
    "CountryName": "country",
    "Locality": "locality",
    "decimalLatitude": "ddlat",
    "decimalLongitude": "ddlong",
    "CollectionMonth": "col_month",
    "CollectionDay": "col_day",
    "CollectionYear": "col_year",
    "DeterminedBy": "det_by",
    "DeterminationYear": "det_year",
}

RAINBIO_COLUMNS = {
    "tax_gen": "genus",
    "tax_esp": "specific_epithet",
    "country": "country",
    "maj_area_original": "region",
    "loc_notes": "locality",
    "ddlat": "ddlat",
    "ddlon": "ddlong",
    "cold": "col_day",
    "colm": "col_month",
    "coly": "col_year",
    "detd": "det_day",
    "detm": "det_month",
    "dety": "det_year",
    "BARCODE": "barcode",
    "detnam": "det_by",
    "colnam": "recorded_by",
    "colnum_full": "colnum_full",
}

SPECIESLINK_COLUMNS = {
    "genus": "genus",
    "species": "specific_epithet",
    "country": "country",
    "locality": "locality",
    "latitude": "ddlat",
    "longitude": "ddlong",
    "collector": "recorded_by",
    "collectornumber": "colnum_full",
    "daycollected": "col_day",
    "monthcollected": "col_month",
    "yearcollected": "col_year",
    "identifiedby": "det_by",
    "dayidentified": "det_day",
    "monthidentified": "det_month",
    "yearidentified": "det_year",
    "institutioncode": "institute",
    "collectioncode": "herbarium_code",
    "catalognumber": "barcode",
}

# ------------------------------- end of fixed values -----------------------


@dataclass(frozen=True)
class SourceSpec:
    """How one provider's delimited file is read."""

    separator: str
    source_id: str
    columns: dict[str, str]
    # Column -> required value, filtered before projection.
    require: dict[str, str] = field(default_factory=dict)
    # Column -> columns tried in order when it is empty.
    fallback: dict[str, list[str]] = field(default_factory=dict)


SOURCES = {
    "P": SourceSpec(";", "P_herbo", HERBONAUTES_COLUMNS),
    "GBIF": SourceSpec(
        "\t", "gbif", DARWIN_CORE_COLUMNS,
        require={"basisOfRecord": "PRESERVED_SPECIMEN", "occurrenceStatus": "PRESENT"},
        fallback={"references": ["bibliographicCitation"]},
    ),
    "BRAHMS": SourceSpec(";", "brahms", BRAHMS_COLUMNS),
    "MO_tropicos": SourceSpec(";", "MO_tropicos", TROPICOS_COLUMNS),
    "RAINBIO": SourceSpec(";", "RAINBIO", RAINBIO_COLUMNS),
    "SPLINK": SourceSpec("\t", "SPLINK", SPECIESLINK_COLUMNS),
}
SOURCES["MO"] = SOURCES["MO_tropicos"]


def column_type(name: str) -> T.DataType:
    if name in INTEGER_COLUMNS:
        return T.IntegerType()
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    return T.StringType()


def struct(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c)) for c in columns])


RAW_SCHEMA = struct(RAW_COLUMNS)
MASTER_SCHEMA = struct(MASTER_COLUMNS)
EXPERT_SCHEMA = struct(EXPERT_COLUMNS)
EXPERT_MIN_SCHEMA = struct(EXPERT_MIN_COLUMNS)


def separator(column: str) -> str:
    return CELL_SEPARATORS.get(column, DEFAULT_SEPARATOR)
