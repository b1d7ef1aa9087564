"""Scalar functions over label texts derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vasculum.functions import barcodes as B, names as N, numbers as O, values as V
from vasculum.functions.nulls import denormalise_nulls, normalise_nulls
from vasculum.schema import SOURCES
from vasculum.sources.readers import standardise_columns
from workload.base import dedup_sql, query, tokens_sql
from workload.view import table

KEYS = ["k_order", "k_line", "k_part", "k_supp"]
KEYS_SQL = "k_order, k_line, k_part, k_supp"

# The texts a label can carry, written once as SQL both engines read alike.
N_, P_ = "CAST(l_orderkey % 1000 AS STRING)", "CAST(l_partkey % 100 AS STRING)"
NUMBER_TEXT = f"""CASE WHEN l_suppkey % 10 = 0 THEN 's.n.' WHEN l_linenumber = 1 THEN {N_}
  WHEN l_linenumber = 2 THEN concat('SJ ', {N_}, 'A') WHEN l_linenumber = 3 THEN concat('PPI ', {N_}, '-', {P_})
  WHEN l_linenumber = 4 THEN concat('SR_', {N_}) WHEN l_linenumber = 5 THEN concat({N_}, '/2011')
  WHEN l_linenumber = 6 THEN concat({N_}, ' ', {P_}, ' 56') ELSE concat({N_}, '-', {P_}, '-4b') END"""
BARCODE_TEXT = """CASE l_linenumber WHEN 1 THEN concat('K000', CAST(l_partkey AS STRING)) WHEN 2 THEN concat('K-000', CAST(l_partkey AS STRING))
  WHEN 3 THEN CAST(l_partkey AS STRING) WHEN 4 THEN concat('ABC-DE-', CAST(l_partkey AS STRING))
  WHEN 5 THEN concat('P 00/', CAST(l_partkey AS STRING)) WHEN 6 THEN 'K0' END"""
INSTITUTE_TEXT = "CASE l_suppkey % 3 WHEN 0 THEN 'MO' WHEN 1 THEN 'Missouri Bot' END"
HERBARIUM_TEXT = "CASE l_suppkey % 4 WHEN 0 THEN 'NY' WHEN 1 THEN 'PLANT' WHEN 2 THEN 'word Code' END"
Y_, M_, D_ = (f"CAST({f}(l_shipdate) AS STRING)" for f in ("year", "month", "day"))
DMY_TEXT = f"CASE WHEN l_suppkey % 6 = 0 THEN NULL WHEN l_linenumber = 1 THEN concat({D_}, '/', {M_}, '/', {Y_}, '-1/1/2020') ELSE concat({D_}, '/', {M_}, '/', {Y_}) END"
ISO_TEXT = f"CASE WHEN l_suppkey % 6 = 0 THEN NULL WHEN l_linenumber = 1 THEN concat({Y_}, '-', {M_}) ELSE concat({Y_}, '-', {M_}, '-', {D_}, 'T00:00:00') END"
YMD_TEXT = f"CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE concat({Y_}, '/', {M_}, '/', {D_}) END"
PAIR_TEXT = "CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN 'unknown' WHEN l_suppkey % 7 = 2 THEN '-9999, 4.5' ELSE concat(CAST(l_orderkey % 90 AS STRING), '.25, -', CAST(l_partkey % 180 AS STRING), '.5') END"
S_ = "concat(upper(substr(split_part(p_name, ' ', 2), 1, 1)), substr(split_part(p_name, ' ', 2), 2))"
G_ = "concat(upper(substr(split_part(p_name, ' ', 1), 1, 1)), substr(split_part(p_name, ' ', 1), 2))"
I_ = "upper(substr(split_part(p_name, ' ', 1), 1, 1))"
_NAME_FORMS = [
    f"concat({S_}, ', ', {I_}, '.')", f"concat({S_}, ', ', {G_})", f"concat({S_}, ' ', {I_})",
    f"concat({G_}, ' ', {S_})", f"concat({I_}, '. ', {S_})", f"concat({S_}, ', ', {I_}, '.B.L.')",
    f"concat('de ', {S_}, ', ', {I_}, 'B')", f"concat({S_}, ', ', {G_}, ' B. L.')",
    f"concat({I_}, '. B. de ', {S_})", f"concat({I_}, 'B ', {S_})", f"concat({S_}, ', ', {I_}, '. B. van')",
    f"concat({G_}, ' de ', {S_})", f"concat({S_}, ' ', {I_}, 'BL de')", S_,
    f"concat('Collector(s): ', {I_}, '. ', {S_}, ' & B. Lee')", "'Unknown'",
    f"concat({G_}, ' B. ', {S_}, ' et al.')", f"concat({S_}, ', ', {G_}, ' Bolt Lee')",
    f"concat({S_}, ', ', {I_}, '. B. L. M. van, and others')", f"concat({G_}, ' Bolt Lee ', {S_}, ' y Roe')",
]
NAME_TEXT = (
    f"CASE (l_orderkey + l_linenumber * 3) % {len(_NAME_FORMS)} "
    + " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(_NAME_FORMS))
    + " END"
)
CELL_TEXT = "concat(p_brand, ', ', p_type, ', ', p_brand, ', <NA>', CASE WHEN l_linenumber % 2 = 0 THEN concat(', ', p_type) ELSE '' END)"
DETS_TEXT = "concat(s_name, ' / ', CASE WHEN l_linenumber % 2 = 0 THEN s_name ELSE 'Doe, J' END)"
CODES_TEXT = "concat('K000', CAST(l_partkey AS STRING), ', ', CAST(l_partkey AS STRING), ', ', CASE WHEN l_linenumber % 2 = 0 THEN 'K0' ELSE CAST(l_suppkey + 5 AS STRING) END)"
HERBARIA_TEXT = "concat('NY, ', CASE WHEN l_linenumber % 2 = 0 THEN 'Missouri Botanical' ELSE 'MO' END)"
TEXTS = {
    "colnum_full": NUMBER_TEXT, "barcode": BARCODE_TEXT, "institute": INSTITUTE_TEXT,
    "herbarium_code": HERBARIUM_TEXT, "dmy": DMY_TEXT, "iso": ISO_TEXT, "ymd": YMD_TEXT,
    "pair": PAIR_TEXT, "person": NAME_TEXT, "cell": CELL_TEXT, "dets": DETS_TEXT,
    "codes": CODES_TEXT, "herbaria": HERBARIA_TEXT, "surname_text": S_, "given_text": G_,
    "species": f"concat({G_}, ' ', p_type)",
    "epithet": "CASE l_linenumber WHEN 1 THEN 'sp.' WHEN 2 THEN 'indet.' WHEN 3 THEN concat(lower(p_type), ' sp.') ELSE lower(p_type) END",
    "sentinel": "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN '-9999' WHEN 4 THEN 'nan' WHEN 5 THEN '<NA>' WHEN 6 THEN concat(' ', p_type, ';x ') ELSE 'None' END",
}
_KEY_LIST = "l_orderkey AS k_order, l_linenumber AS k_line, l_partkey AS k_part, l_suppkey AS k_supp"


def texts(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.selectExpr(*[p.strip() for p in _KEY_LIST.split(",")], *[f"{TEXTS[n]} AS {n}" for n in names])


def texts_sql(*names: str) -> str:
    items = ", ".join(f"{TEXTS[n]} AS {n}" for n in names)
    return (
        f"texts AS (SELECT {_KEY_LIST}, {items} FROM lineitem JOIN part ON l_partkey = p_partkey "
        "JOIN supplier ON l_suppkey = s_suppkey)"
    ).replace("AS STRING", "AS VARCHAR")


def ask(name: str, columns: tuple[str, ...], select: str):
    """Register a function over label texts; `select` is the SQL side's select list."""
    return query(name, f"WITH {texts_sql(*columns)} SELECT {KEYS_SQL}, {select} FROM texts")


def _x(pattern: str, group: int = 1, c: str = "colnum_full") -> str:
    return f"nullif(trim(regexp_extract({c}, '{pattern}', {group})), '')"


_PREFIX = _x("^([a-zA-Z]*)")


def _number_sql(suffix: str, core: str) -> str:
    return f"{_PREFIX} AS prefix, {suffix} AS sufix, {_x(core)} AS colnum"


_SUFFIX_SPACED = _x(r"([a-zA-Z ]*$|SR_\d+|R_\d+)")
_SUFFIX_TIGHT = _x(r"([a-zA-Z]*$|SR_\d+|R_\d+)")
_SUFFIX_DIGITS = f"coalesce({_x(r'[a-zA-Z ]*[0-9]+([a-zA-Z][0-9]+)$')}, {_x(r'[a-zA-Z ]*[0-9]+([a-zA-Z]+)$')})"
_FORMS = {"slash": r"\d+/\d+", "three": r"\d+-\d+-\d+", "two": r"\d+-\d+", "spaced": r"\d+\s\d+\s\d+", "dot": r"\d+\.\d+", "plain": r"\d+"}


def _core(*names: str) -> str:
    return "(" + "|".join(_FORMS[n] for n in names) + ")"


def _numbers(source: str):
    return lambda spark, folder: texts(spark, folder, "colnum_full").select(
        *KEYS, *[c.alias(n) for n, c in O.split_colnum(F.col("colnum_full"), source).items()]
    )


_BROAD = _core("slash", "three", "two", "spaced", "dot", "plain")
_NARROW = _core("slash", "three", "two", "dot", "plain")
for _source, _suffix, _form in [
    ("P", _SUFFIX_SPACED, _BROAD),
    ("GBIF", _SUFFIX_TIGHT, _NARROW),
    ("RAINBIO", _SUFFIX_DIGITS, _BROAD),
    ("MO_tropicos", _SUFFIX_SPACED, _NARROW),
    ("SPLINK", _SUFFIX_SPACED, _NARROW),
    ("expert", _SUFFIX_SPACED, _core("slash", "three", "spaced", "dot", "plain")),
]:
    ask(f"colnum_{_source.lower()}", ("colnum_full",), _number_sql(_suffix, _form))(_numbers(_source))


@ask("colnum_join", ("colnum_full",),
     f"nullif(trim(concat({_PREFIX}, {_x(_NARROW)}, {_SUFFIX_SPACED})), '') AS colnum_full")
def colnum_join(spark, folder):
    parts = O.split_colnum(F.col("colnum_full"), "SPLINK")
    return texts(spark, folder, "colnum_full").select(
        *KEYS, O.join_colnum(parts["prefix"], parts["colnum"], parts["sufix"]).alias("colnum_full")
    )


_CODE = _x(r"(^\w+$|\d+-\d+/\d+$|\d+:\d+:\d+$|\d+-\d+$|\d+/\d+$|\d+\.\d+$|\d+\s\d+$|\d+$)", c="barcode")
_OWN = [_x(f"({p})", c="barcode") for p in (r"^[A-Z]+-[A-Z]+-", r"^[A-Z]+\s[A-Z]+", r"^[A-Z]+-", r"^[A-Z]+")]


def _barcode_sql(fallbacks: list[str], zero: bool) -> str:
    acronym = f"coalesce({', '.join(_OWN + fallbacks)}, '')"
    fixed = f"CASE WHEN {acronym} = 'PLANT' THEN 'TAIF' ELSE {acronym} END"
    full = f"CASE WHEN regexp_matches({_CODE}, '[A-Z]') THEN {_CODE} ELSE ({fixed}) || {_CODE} END"
    return f"CASE WHEN NOT regexp_matches({full}, '^[A-Z]+0$') THEN {full} END" if zero else full


@ask("barcode_gbif", ("barcode", "institute"),
     _barcode_sql([f"CASE WHEN NOT regexp_matches(institute, '[a-z]') THEN {_x('^([A-Z]+)', c='institute')} END"], True) + " AS barcode")
def barcode_gbif(spark, folder):
    return texts(spark, folder, "barcode", "institute").select(
        *KEYS, B.gbif_barcode(F.col("barcode"), F.col("institute")).alias("barcode")
    )


@ask("barcode_splink", ("barcode", "herbarium_code", "institute"),
     _barcode_sql([_x("^([A-Z]+)", c="herbarium_code"), _x("^([A-Z]+)", c="institute")], False) + " AS barcode")
def barcode_splink(spark, folder):
    return texts(spark, folder, "barcode", "herbarium_code", "institute").select(
        *KEYS, B.splink_barcode(F.col("barcode"), F.col("herbarium_code"), F.col("institute")).alias("barcode")
    )


@ask("barcode_cells", ("codes", "herbaria"),
     """nullif(array_to_string(list_filter(string_split(codes, ', '), lambda t: NOT regexp_matches(t, '^[A-Z]+0$')
       AND NOT (regexp_matches(t, '^[0-9]+$') AND len(list_filter(string_split(codes, ', '), lambda o: o <> t AND suffix(o, t))) > 0)), ', '), '') AS barcode,
     len(list_filter(string_split(codes, ', '), lambda t: regexp_matches(t, '^[0-9]'))) > 0 AS bare,
     nullif(array_to_string(list_filter(string_split(herbaria, ', '), lambda t: NOT regexp_matches(t, '^[A-Z][a-z]+.+$')), ', '), '') AS herbaria""")
def barcode_cells(spark, folder):
    return texts(spark, folder, "codes", "herbaria").select(
        *KEYS,
        B.tidy_barcode_cell(F.col("codes")).alias("barcode"),
        B.has_bare_number(F.col("codes")).alias("bare"),
        B.code_tokens(F.col("herbaria")).alias("herbaria"),
    )


def _int(text: str) -> str:
    return f"nullif(try_cast({text} AS INTEGER), 0)"


@ask("dates", ("dmy", "iso", "ymd"),
     ", ".join(
         [f"{_int(f'''split_part(split_part(dmy, '-', 1), '/', {i})''')} AS col_{u}" for i, u in enumerate(("day", "month", "year"), 1)]
         + [f"{_int(f'''split_part(split_part(iso, 'T', 1), '-', {i})''')} AS det_{u}" for i, u in enumerate(("year", "month", "day"), 1)]
         + [f"{_int(f'''split_part(ymd, '/', {i})''')} AS exp_{u}" for i, u in enumerate(("year", "month", "day"), 1)]
         + ["try_cast(nullif(regexp_extract(iso, '([0-9]+)', 1), '') AS INTEGER) AS digits",
            "split_part(ymd, '/', 1) || '/' || split_part(ymd, '/', 2) || '/' || split_part(ymd, '/', 3) AS composed"]
     ))
def dates(spark, folder):
    df = texts(spark, folder, "dmy", "iso", "ymd")
    parts = V.day_month_year(F.col("dmy"), "col") | V.iso_date(F.col("iso"), "det") | V.year_month_day(F.col("ymd"), "exp")
    return df.withColumns(parts).select(
        *KEYS, *parts, V.year_digits(F.col("iso")).alias("digits"),
        V.compose_date(F.col("exp_year"), F.col("exp_month"), F.col("exp_day")).alias("composed"),
    )


_LAT, _LON = (f"try_cast(trim(split_part(pair, ',', {i})) AS DOUBLE)" for i in (1, 2))


@ask("coordinate_pairs", ("pair",),
     f"CASE WHEN {_LAT} <> -9999 THEN {_LAT} END AS ddlat, CASE WHEN {_LON} <> -9999 THEN {_LON} END AS ddlong")
def coordinate_pairs(spark, folder):
    pair = V.lat_long_pair(F.col("pair"))
    return texts(spark, folder, "pair").select(*KEYS, *[c.alias(n) for n, c in pair.items()])


@ask("taxon_text", ("species", "epithet"),
     """split_part(species, ' ', 1) AS genus, split_part(species, ' ', 2) AS specific_epithet,
     nullif(array_to_string(list_filter(string_split(epithet, ' '), lambda t: t NOT IN ('sp.', 'indet.')), ' '), '') AS epithet,
     split_part(species, ' ', 1) || ' ' || nullif(array_to_string(list_filter(string_split(epithet, ' '), lambda t: t NOT IN ('sp.', 'indet.')), ' '), '') AS taxon""")
def taxon_text(spark, folder):
    parts = V.genus_and_epithet(F.col("species"))
    df = texts(spark, folder, "species", "epithet").withColumns(
        parts | {"epithet": V.strip_open_nomenclature(F.col("epithet"))}
    )
    return df.select(*KEYS, *parts, "epithet", V.taxon_key(F.col("genus"), F.col("epithet")).alias("taxon"))


def _first_collector_sql(c: str, junior: str = "JUNIOR") -> str:
    for old, new in [("Collector(s):", ""), ("Unknown", ""), ("&", ";"), (" y ", ";"), (" and ", ";"),
                     ("Jr.", junior), ("et al.", ""), ("et al", ""), ("etal", "")]:
        c = f"replace({c}, '{old}', '{new}')"
    return f"nullif(trim(split_part({c}, ';', 1)), '')"


def _name_rules() -> list[tuple[str, str]]:
    """Every name form as a rule of its own, from most to least specific."""
    big, low = "[A-ZÀ-Ÿ]", "[a-zà-ÿ]"
    sur, one, given, part = f"({big}{low}+)", f"({big})", f"({big}){low}+", f"({low}{{0,3}})"
    rules = []

    def add(pattern: str, surname: int, initials: range, particle: int | None = None):
        rules.append((pattern, rf"\{surname}, " + "".join(rf"\{i}" for i in initials) + (rf" \{particle}" if particle else "")))

    for n in (4, 3, 2):
        names = r"\s+".join([given] * n)
        add(rf"{sur},\W+{names}\s+{part}", 1, range(2, n + 2), n + 2)
        add(rf"{sur},\W+{names}", 1, range(2, n + 2))
    add(rf"{sur},\W+{one}{low}{{2,20}}\s+{part}", 1, range(2, 3), 3)
    add(rf"{sur},\W+{one}{low}{{2,20}}", 1, range(2, 3))
    for n in (4, 3):
        dots = r"\W+".join([one] * n)
        add(rf"{sur},\W+{dots}\W*\s+{part}", 1, range(2, n + 2), n + 2)
        add(rf"{sur},\W+{dots}\W*", 1, range(2, n + 2))
    dots = r"\W+".join([one] * 3)
    add(rf"{sur},\W+{dots}\W\s+{part},.+", 1, range(2, 5), 5)
    add(rf"{sur},\W+{dots}\W,.+", 1, range(2, 5))
    for n in (2, 1):
        dots = r"\W+".join([one] * n)
        add(rf"{sur},\W+{dots}\W+\s+{part}", 1, range(2, n + 2), n + 2)
        add(rf"{sur},\W+{dots}\W+", 1, range(2, n + 2))
    for n in (4, 3, 2, 1):
        add(rf"{sur}\W+{one * n}\s+{part}", 1, range(2, n + 2), n + 2)
        add(rf"{sur}\W+{one * n}", 1, range(2, n + 2))
    rules.append((rf"{sur}\W*", r"\1"))
    for n in (4, 3, 2, 1):
        names = r"\s".join([given] * n)
        add(rf"{names}\s{part}\s{sur}", n + 2, range(1, n + 1), n + 1)
        add(rf"{names}\s{sur}", n + 1, range(1, n + 1))
    add(rf"{given}\s{one}\W+{part}\s{sur}", 4, range(1, 3), 3)
    add(rf"{given}\s{one}\W+{sur}", 3, range(1, 3))
    for n in (1, 2, 3, 4):
        dots = rf"{one}\W+" * n
        add(rf"{dots}{part}\s{sur}", n + 2, range(1, n + 1), n + 1)
        add(rf"{dots}{sur}", n + 1, range(1, n + 1))
    for n in (4, 3, 2):
        add(rf"{one * n}\W+{part}\s{sur}", n + 2, range(1, n + 1), n + 1)
        add(rf"{one * n}\W+{sur}", n + 1, range(1, n + 1))
    return rules


def standard_name_sql(c: str) -> str:
    cases = " ".join(
        f"WHEN regexp_full_match({c}, '{p}') THEN trim(regexp_replace({c}, '^{p}$', '{r}'))" for p, r in _name_rules()
    )
    return f"CASE {cases} END"


@query("names_standard",
       f"WITH {texts_sql('person')}, cut AS (SELECT *, {_first_collector_sql('person')} AS who FROM texts), "
       f"named AS (SELECT *, {standard_name_sql('who')} AS recorded_by FROM cut) "
       f"SELECT {KEYS_SQL}, person, who, recorded_by, split_part(recorded_by, ',', 1) AS coll_surname, "
       "nullif(split_part(recorded_by, ', ', 2), '') AS given FROM named")
def names_standard(spark, folder):
    return (
        texts(spark, folder, "person")
        .withColumn("who", N.first_collector(F.col("person")))
        .withColumn("recorded_by", N.standardise_name(F.col("who")))
        .withColumns({"coll_surname": N.surname(F.col("recorded_by")), "given": N.given_names(F.col("recorded_by"))})
    )


@ask("name_similarity", ("surname_text", "given_text"),
     """round(1 - levenshtein(surname_text, given_text) / greatest(length(surname_text), length(given_text)) + 0.00000003, 6) AS similarity""")
def name_similarity(spark, folder):
    return texts(spark, folder, "surname_text", "given_text").select(
        *KEYS, F.round(N.levenshtein_similarity(F.col("surname_text"), F.col("given_text")) + 0.00000003, 6).alias("similarity")
    )


@ask("indel_ratio", ("surname_text", "given_text"),
     """round(CASE WHEN length(surname_text) + length(given_text) = 0 THEN 100.0 ELSE 200.0 * coalesce(CASE WHEN length(given_text) > 0 THEN
     list_reduce(list_concat([list_transform(range(length(given_text)), lambda j: 0)], list_transform(range(length(surname_text)), lambda i: [i])),
       lambda line, letter: list_reduce(list_concat([[0]], list_transform(range(length(given_text)), lambda j: [j])),
         lambda done, k: list_append(done, CASE WHEN surname_text[letter[1] + 1] = given_text[k[1] + 1]
           THEN coalesce(CASE WHEN k[1] > 0 THEN line[k[1]] END, 0) + 1
           ELSE greatest(line[k[1] + 1], CASE WHEN k[1] > 0 THEN done[k[1] + 1] ELSE 0 END) END))[2:])[-1] END, 0) / (length(surname_text) + length(given_text)) END
     + 0.00000003, 6) AS ratio""")
def indel_ratio(spark, folder):
    return texts(spark, folder, "surname_text", "given_text").select(
        *KEYS, F.round(N.indel_ratio("surname_text", "given_text") + 0.00000003, 6).alias("ratio")
    )


@ask("cell_dedup", ("cell", "dets"),
     f"{dedup_sql('cell')} AS cell, {dedup_sql('dets', ' / ')} AS dets, len({tokens_sql('cell')}) AS n_values")
def cell_dedup(spark, folder):
    return texts(spark, folder, "cell", "dets").select(
        *KEYS, V.dedup_cell(F.col("cell"), ", ").alias("cell"), V.dedup_cell(F.col("dets"), " / ").alias("dets"),
        F.size(V.tokens_of(F.col("cell"), ", ")).alias("n_values"),
    )


_CLEAN = "CASE WHEN trim(sentinel) NOT IN ('', '-9999', 'nan', 'NaN', 'None', '<NA>') THEN trim(sentinel) END"


@ask("nulls", ("sentinel",),
     f"{_CLEAN} AS clean, coalesce(replace({_CLEAN}, ';', ','), '-9999') AS written")
def nulls(spark, folder):
    df = normalise_nulls(texts(spark, folder, "sentinel"), ["sentinel"])
    return denormalise_nulls(df.withColumn("written", F.col("sentinel"))).withColumn(
        "clean", F.nullif("sentinel", F.lit("-9999"))
    ).withColumn("clean", F.when(F.col("clean").isNotNull(), F.translate("clean", ",", ";"))).drop("sentinel")


# --- provider columns ---------------------------------------------------------------------

_DARWIN_CORE = {
    "basisOfRecord": "CASE WHEN l_returnflag = 'R' THEN 'HUMAN_OBSERVATION' ELSE 'PRESERVED_SPECIMEN' END",
    "occurrenceStatus": "CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'ABSENT' ELSE 'PRESENT' END",
    "scientificName": "p_name", "genus": G_, "species": TEXTS["species"], "countryCode": "'GA'",
    "locality": "p_brand", "decimalLatitude": "CAST(l_suppkey % 90 AS STRING)",
    "decimalLongitude": "CASE WHEN l_suppkey % 5 = 0 THEN '-9999' ELSE CAST(l_suppkey AS STRING) END",
    "recordedBy": NAME_TEXT, "recordNumber": NUMBER_TEXT, "day": D_, "month": M_, "year": Y_,
    "identifiedBy": "s_name", "dateIdentified": ISO_TEXT, "institutionCode": INSTITUTE_TEXT,
    "collectionCode": HERBARIUM_TEXT, "catalogNumber": BARCODE_TEXT,
    "references": "CASE WHEN l_linenumber % 2 = 0 THEN concat('http://', CAST(l_partkey AS STRING)) END",
    "bibliographicCitation": "concat('cited ', CAST(l_suppkey AS STRING))", "ignored": "'x'",
}


@query(
    "source_gbif",
    ("SELECT p_name AS scientific_name, " + G_ + " AS genus, " + TEXTS["species"] + " AS \"species-tobesplit\", 'GA' AS country_id, "
     "p_brand AS locality, CAST(l_suppkey % 90 AS STRING) AS ddlat, CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_suppkey AS STRING) END AS ddlong, "
     + NAME_TEXT + " AS recorded_by, " + NUMBER_TEXT + " AS colnum_full, " + D_ + " AS col_day, " + M_ + " AS col_month, " + Y_ + " AS col_year, "
     "s_name AS det_by, " + ISO_TEXT + " AS det_date, " + INSTITUTE_TEXT + " AS institute, " + HERBARIUM_TEXT + " AS herbarium_code, "
     + BARCODE_TEXT + " AS barcode, coalesce(CASE WHEN l_linenumber % 2 = 0 THEN concat('http://', CAST(l_partkey AS STRING)) END, "
     "concat('cited ', CAST(l_suppkey AS STRING))) AS link, 'gbif' AS source_id "
     "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey "
     "WHERE l_returnflag <> 'R' AND NOT (l_linestatus = 'O' AND l_linenumber = 7)").replace("AS STRING", "AS VARCHAR"),
)
def source_gbif(spark, folder):
    rows = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    provider = rows.selectExpr(*[f"{e} AS `{c}`" for c, e in _DARWIN_CORE.items()])
    return standardise_columns(provider, SOURCES["GBIF"])
