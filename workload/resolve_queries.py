"""Authority resolution: taxa, collectors, countries, fuzzy names."""

from __future__ import annotations

from pyspark.sql import functions as F

from vasculum.functions.names import first_collector, standardise_name
from vasculum.operators.authorities import (
    country_crossfill, match_botanists, resolve_collectors, resolve_expert_taxa, resolve_taxa,
)
from vasculum.operators.fuzzy import best_names, prepare_reference
from vasculum.operators.stats import resolution_report
from workload.base import query, with_view
from workload.text_queries import G_, I_, S_, KEYS, _first_collector_sql, standard_name_sql, texts, texts_sql
from workload.view import specimens, table

ROW = ["k_order", "k_line", "k_part", "k_supp"]
ROW_SQL = ", ".join(ROW)

# --- taxa -----------------------------------------------------------------------------------

BACKBONE = """SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS genus,
  CASE WHEN p_type = 'MEDIUM' THEN 'medium' ELSE p_type END AS epithet,
  length(p_name) % 3 <> 0 AND p_size > 4 AS accepted,
  concat(split_part(p_name, ' ', 1), ' ', CASE WHEN p_type = 'MEDIUM' THEN 'medium' ELSE p_type END) AS name,
  p_brand AS author, p_partkey - p_partkey % 4 + 1 AS accepted_id, 1800 + p_size AS pub_year FROM part"""
BACKBONE_CTES = f"""backbone AS ({BACKBONE}),
hits AS (SELECT genus || ' ' || epithet AS taxon, first(id ORDER BY NOT accepted, id) AS id FROM backbone GROUP BY 1),
answers AS (SELECT h.taxon, CASE WHEN b.accepted THEN 'ACCEPTED' ELSE 'SYNONYM' END AS status,
  CASE WHEN b.accepted THEN h.taxon ELSE a.name END AS accepted_name, CASE WHEN b.accepted THEN b.author ELSE a.author END AS ipni_species_author,
  'https://ipni.org/n/' || CAST(b.id AS VARCHAR) AS ipni_no, b.author, b.id, b.pub_year
  FROM hits h JOIN backbone b ON h.id = b.id LEFT JOIN backbone a ON b.accepted_id = a.id)"""


def backbone(spark, folder):
    table(spark, folder, "part").createOrReplaceTempView("part")
    return spark.sql(BACKBONE)


@query("resolve_taxa", with_view(BACKBONE_CTES, select=f"""SELECT {ROW_SQL}, genus, specific_epithet,
  CASE WHEN specific_epithet IS NULL THEN 'not det' ELSE coalesce(a.status, 'not found in POWO') END AS status,
  a.accepted_name, a.ipni_species_author, a.ipni_no FROM specimens s LEFT JOIN answers a ON s.genus || ' ' || s.specific_epithet = a.taxon"""))
def taxa(spark, folder):
    return resolve_taxa(specimens(spark, folder), backbone(spark, folder)).select(
        *ROW, "genus", "specific_epithet", "status", "accepted_name", "ipni_species_author", "ipni_no"
    )


@query("resolve_taxa_distribution", with_view(BACKBONE_CTES, select=f"""SELECT {ROW_SQL},
  CASE WHEN b.accepted THEN b.author || '+' || b.genus ELSE a.author || '+' || a.genus END AS native_to
  FROM specimens s LEFT JOIN hits h ON s.genus || ' ' || s.specific_epithet = h.taxon
  LEFT JOIN backbone b ON h.id = b.id LEFT JOIN backbone a ON b.accepted_id = a.id"""))
def taxa_distribution(spark, folder):
    ranges = backbone(spark, folder).withColumn("native_to", F.array("author", "genus"))
    return resolve_taxa(specimens(spark, folder), ranges, True).select(*ROW, F.array_join("native_to", "+").alias("native_to"))


@query("resolve_expert_taxa", with_view(BACKBONE_CTES, select=f"""SELECT {ROW_SQL}, s.accepted_name,
  a.author AS ipni_species_author, a.ipni_no, a.pub_year AS ipni_pub FROM specimens s LEFT JOIN answers a ON s.accepted_name = a.taxon"""))
def expert_taxa(spark, folder):
    return resolve_expert_taxa(specimens(spark, folder), backbone(spark, folder)).select(
        *ROW, "accepted_name", "ipni_species_author", "ipni_no", "ipni_pub"
    )


# --- collectors -----------------------------------------------------------------------------

BOTANISTS = f"""SELECT p_partkey AS link_id, CASE p_partkey % 6 WHEN 0 THEN concat({S_}, ', ', {G_}) WHEN 1 THEN concat({S_}, ', ', {G_}, ' Bolt Lee')
  WHEN 2 THEN concat({G_}, ' ', {S_}) WHEN 3 THEN concat({S_}, ', ', {G_}, ', Roe, A') WHEN 4 THEN concat({S_}, ', ', {I_}, 'am')
  ELSE concat({S_}, ', ', {I_}, '. B.') END AS name,
  CASE WHEN p_size % 4 <> 0 THEN 1900 + p_size * 2 END AS dobirth, CASE WHEN p_size % 8 = 1 THEN 1960 + p_size * 2 END AS dodeath,
  p_brand AS geo_col, CASE WHEN p_partkey % 5 = 0 THEN concat('w', CAST(p_partkey AS STRING)) END AS wiki_url FROM part"""
COLLECTOR_CTES = f"""botanists AS ({BOTANISTS.replace('AS STRING', 'AS VARCHAR')}),
{texts_sql('person', 'ymd')},
records AS (SELECT *, {_first_collector_sql('person')} AS who FROM texts),
collected AS (SELECT *, {standard_name_sql('who')} AS recorded_by, try_cast(split_part(ymd, '/', 1) AS INTEGER) AS col_year FROM records),
asked AS (SELECT recorded_by, last(col_year ORDER BY k_order, k_line, k_part, k_supp, col_year NULLS FIRST) AS col_year,
  last(person ORDER BY k_order, k_line, k_part, k_supp, col_year NULLS FIRST) AS label FROM collected WHERE recorded_by IS NOT NULL GROUP BY recorded_by),
people AS (SELECT *, {standard_name_sql('name')} AS standard FROM botanists),
candidates AS (SELECT a.*, p.*, split_part(standard, ',', 1) AS sur FROM asked a JOIN people p ON split_part(a.recorded_by, ',', 1) = split_part(p.standard, ',', 1)
  WHERE starts_with(coalesce(nullif(trim(substr(p.standard, length(split_part(p.standard, ',', 1)) + 3)), ''), ''),
    trim(regexp_replace(CASE WHEN contains(a.recorded_by, ', ') THEN substr(a.recorded_by, length(split_part(a.recorded_by, ',', 1)) + 3) ELSE '' END, '[a-z]', '', 'g'))))"""


def botanists(spark, folder):
    table(spark, folder, "part").createOrReplaceTempView("part")
    return spark.sql(BOTANISTS)


def collected(spark, folder):
    return (
        texts(spark, folder, "person", "ymd")
        .withColumn("orig_recby", F.col("person"))
        .withColumn("recorded_by", standardise_name(first_collector(F.col("person"))))
        .withColumn("col_year", F.split_part("ymd", F.lit("/"), F.lit(1)).try_cast("int"))
        .withColumns({c: F.lit(None).cast("string") for c in ("huh_name", "geo_col", "wiki_url")})
    )


@query("match_botanists", f"WITH {COLLECTOR_CTES} SELECT recorded_by, link_id FROM candidates")
def botanist_candidates(spark, folder):
    asked = collected(spark, folder).select("recorded_by").filter("recorded_by IS NOT NULL").distinct()
    return match_botanists(asked, botanists(spark, folder)).select("recorded_by", "link_id")


VERDICT_CTES = COLLECTOR_CTES + """,
formal AS (SELECT *, contains(name, ',') AS comma, CASE WHEN contains(name, ', ') THEN split_part(split_part(name, ', ', 2), ' ', 1) ELSE '' END AS given
  FROM candidates WHERE length(name) - length(replace(name, ',', '')) < 2),
votes AS (SELECT *, len(list_filter(string_split(replace(replace(label, ',', ' '), '.', ' '), ' '), lambda t: t <> '' AND contains(given, t))) > 0 AS vote FROM formal),
ranked AS (SELECT *, len(string_split(name, ' ')) AS w, length(name) AS l FROM votes),
persons AS (SELECT recorded_by, col_year, comma, vote, sur, given, count(*) AS entries, last(name ORDER BY w, l, name, link_id) AS name,
  last(dobirth ORDER BY w, l, name, link_id) FILTER (WHERE dobirth IS NOT NULL) AS dobirth, last(dodeath ORDER BY w, l, name, link_id) FILTER (WHERE dodeath IS NOT NULL) AS dodeath,
  last(geo_col ORDER BY w, l, name, link_id) FILTER (WHERE geo_col IS NOT NULL) AS geo_col, last(wiki_url ORDER BY w, l, name, link_id) FILTER (WHERE wiki_url IS NOT NULL) AS wiki_url
  FROM ranked GROUP BY ALL),
step1 AS (SELECT * FROM (SELECT *, sum(entries) OVER (PARTITION BY recorded_by) AS total FROM persons) WHERE total = 1 OR comma),
step2 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY recorded_by) AS np, bool_or(vote) OVER (PARTITION BY recorded_by) AS anyvote FROM step1) WHERE np = 1 OR NOT anyvote OR vote),
step3 AS (SELECT * FROM step2 WHERE coalesce(dobirth <= col_year, true) AND coalesce(dodeath >= col_year, true)),
answers AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY recorded_by) AS left_over FROM step3) WHERE left_over = 1)"""


@query("resolve_collectors", f"""WITH {VERDICT_CTES} SELECT k_order, k_line, k_part, k_supp, c.recorded_by AS recby_regex,
  coalesce(a.name, c.recorded_by) AS recorded_by, coalesce(a.name, c.recorded_by) AS huh_name, a.geo_col, a.wiki_url
  FROM collected c LEFT JOIN answers a ON c.recorded_by = a.recorded_by""")
def collectors(spark, folder):
    df = resolve_collectors(collected(spark, folder), botanists(spark, folder), [*KEYS, "col_year"])
    return df.select(*KEYS, "recby_regex", "recorded_by", "huh_name", "geo_col", "wiki_url")


@query("resolution_report", f"""WITH {VERDICT_CTES}, names AS (SELECT DISTINCT c.recorded_by, a.name FROM collected c
  LEFT JOIN answers a ON c.recorded_by = a.recorded_by WHERE c.recorded_by IS NOT NULL)
  SELECT count(*) AS names, count(*) - count(name) AS unresolved, round(100 * count(name) / count(*), 4) AS resolved_percent FROM names""")
def report(spark, folder):
    df = resolve_collectors(collected(spark, folder), botanists(spark, folder), [*KEYS, "col_year"])
    names = df.filter("recby_regex IS NOT NULL").select(
        "recby_regex", F.when(F.col("geo_col").isNotNull(), F.col("huh_name")).alias("huh_name")
    ).distinct()
    return resolution_report(names)


# --- countries ------------------------------------------------------------------------------

COUNTRIES = """SELECT n_name AS alias, concat('N', chr(65 + n_nationkey)) AS iso2, concat('C', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS iso3,
  concat('Land ', CAST(n_nationkey AS STRING)) AS name_short FROM nation
  UNION ALL SELECT concat('Land ', CAST(n_nationkey AS STRING)), concat('N', chr(65 + n_nationkey)), concat('C', lpad(CAST(n_nationkey AS STRING), 2, '0')),
  concat('Land ', CAST(n_nationkey AS STRING)) FROM nation"""
COUNTRIES_SQL = f"countries AS ({COUNTRIES.replace('AS STRING', 'AS VARCHAR')})"


def countries(spark, folder):
    table(spark, folder, "nation").createOrReplaceTempView("nation")
    return spark.sql(COUNTRIES)


STATED = "CASE WHEN k_line % 4 = 0 THEN NULL WHEN k_line = 5 THEN 'Atlantis' WHEN k_line = 3 THEN lower(country) ELSE country END"
STATED_ID = "CASE WHEN k_line IN (3, 4) THEN concat('N', chr(65 + CAST(substr(country_iso3, 2) AS INT))) END"


@query("country_crossfill", with_view(COUNTRIES_SQL, f"stated AS (SELECT * REPLACE ({STATED} AS country), {STATED_ID} AS country_id FROM specimens)",
       select=f"""SELECT {ROW_SQL}, coalesce(s.country_id, a.iso2) AS country_id, coalesce(s.country, i.name_short) AS country,
  CASE WHEN s.country IS NULL THEN i.iso3 ELSE a.iso3 END AS country_iso3 FROM stated s
  LEFT JOIN (SELECT DISTINCT lower(alias) AS alias, iso2, iso3 FROM countries) a ON lower(s.country) = a.alias
  LEFT JOIN (SELECT DISTINCT iso2, iso3, name_short FROM countries) i ON coalesce(s.country_id, a.iso2) = i.iso2"""))
def country_fill(spark, folder):
    df = specimens(spark, folder).withColumns({"country_id": F.expr(STATED_ID), "country": F.expr(STATED)})
    return country_crossfill(df, countries(spark, folder)).select(*ROW, "country_id", "country", "country_iso3")


# --- fuzzy names ----------------------------------------------------------------------------

REFERENCE = f"""SELECT CASE p_partkey % 4 WHEN 0 THEN concat({S_}, ', ', {I_}) WHEN 1 THEN concat({S_}, 'ss, ', {G_})
  WHEN 2 THEN concat(substr({S_}, 1, 1), substr({S_}, 3), ', ', {I_}, 'BL') ELSE concat('Von', {S_}) END AS listed FROM part"""


def _fuzzy_sql(surnames: str) -> str:
    """Best names, given the CTE (s, rs) of each surname's best reference surname."""
    return f"""WITH {COLLECTOR_CTES}, listed AS (SELECT DISTINCT listed AS full_name, split_part(listed, ',', 1) AS rs,
  coalesce(nullif(split_part(listed, ', ', 2), ''), '0') AS rg FROM ({REFERENCE})),
names AS (SELECT DISTINCT recorded_by AS name, split_part(recorded_by, ',', 1) AS s, coalesce(nullif(split_part(recorded_by, ', ', 2), ''), ' ') AS g FROM collected WHERE recorded_by IS NOT NULL),
{surnames},
pairs AS (SELECT name, g, full_name, rg, 1 - levenshtein(g, rg) / greatest(length(g), length(rg)) AS score FROM names JOIN surnames USING (s) JOIN listed USING (rs)),
best AS (SELECT name, first(full_name ORDER BY -score, full_name) AS best_name FROM pairs GROUP BY name)
SELECT n.name, b.best_name, round(p.score, 6) AS score, substr(p.g, 1, 1) = substr(p.rg, 1, 1) AS initial_agrees
FROM names n LEFT JOIN best b ON n.name = b.name LEFT JOIN pairs p ON p.name = n.name AND p.full_name = b.best_name"""


# All surnames against all: the table of common subsequence lengths, letter by letter, packed in a list for each pair.
ALL_SURNAMES = """sides AS (SELECT s, rs FROM (SELECT DISTINCT s FROM names), (SELECT DISTINCT rs FROM listed)),
common AS (SELECT s, rs, list_reduce(
    list_concat([list_transform(range(length(rs)), lambda j: 0)], list_transform(range(length(s)), lambda i: [i])),
    lambda line, letter: list_reduce(list_concat([[0]], list_transform(range(length(rs)), lambda j: [j])),
      lambda done, k: list_append(done, CASE WHEN s[letter[1] + 1] = rs[k[1] + 1]
        THEN coalesce(CASE WHEN k[1] > 0 THEN line[k[1]] END, 0) + 1
        ELSE greatest(line[k[1] + 1], CASE WHEN k[1] > 0 THEN done[k[1] + 1] ELSE 0 END) END))[2:])[-1] AS lcs FROM sides),
surnames AS (SELECT s, first(rs ORDER BY -2.0 * lcs / (length(s) + length(rs)), rs) AS rs FROM common GROUP BY s)"""

NEAR_SURNAMES = """surnames AS (SELECT s, first(rs ORDER BY levenshtein(s, rs) / greatest(length(s), length(rs)), rs) AS rs FROM (SELECT DISTINCT s FROM names), (SELECT DISTINCT rs FROM listed)
  WHERE levenshtein(s, rs) <= 2 GROUP BY s)"""


def _reference(spark, folder):
    table(spark, folder, "part").createOrReplaceTempView("part")
    return prepare_reference(spark.sql(REFERENCE), "listed")


@query("fuzzy_best", _fuzzy_sql(ALL_SURNAMES))
def fuzzy(spark, folder):
    return best_names(collected(spark, folder), "recorded_by", _reference(spark, folder))


@query("fuzzy_within_two", _fuzzy_sql(NEAR_SURNAMES))
def fuzzy_within_two(spark, folder):
    return best_names(collected(spark, folder), "recorded_by", _reference(spark, folder), 2)
