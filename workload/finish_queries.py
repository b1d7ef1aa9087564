"""The final cleaning over the specimen view."""

from __future__ import annotations

from pyspark.sql import functions as F

from vasculum.operators import rules as R
from vasculum.plans.finisher import finish
from vasculum.schema import EXPERT_KEYS
from workload.base import EXPERT_FIRST, TIE, query, tidy, tidy_sql, with_view
from workload.dedup_queries import merged_sql
from workload.view import ORDER, specimens

KEYS_SQL = "k_order, k_line, k_part, k_supp"
# Cells as they come from many hands: a code beside its bare number and an empty one, words beside codes, bare numbers alone.
CODES = "CASE k_line % 4 WHEN 0 THEN concat(barcode, ', ', substr(barcode, 3), ', K0') WHEN 1 THEN concat('7', substr(barcode, 3)) ELSE barcode END"
HERBARIA = "CASE WHEN k_line % 2 = 0 THEN concat('NY, Missouri Botanical, ', herbarium_code) ELSE herbarium_code END"

_TOKENS = "string_split({c}, ', ')"
_TIDY = f"""nullif(array_to_string(list_filter({_TOKENS.format(c='barcode')}, lambda t: NOT regexp_matches(t, '^[A-Z]+0$')
  AND NOT (regexp_matches(t, '^[0-9]+$') AND len(list_filter({_TOKENS.format(c='barcode')}, lambda o: o <> t AND suffix(o, t))) > 0)), ', '), '')"""


def _codes_sql(c: str) -> str:
    return f"nullif(array_to_string(list_filter({_TOKENS.format(c=c)}, lambda t: NOT regexp_matches(t, '^[A-Z][a-z]+.+$')), ', '), '') AS {c}"


CTES = f"""odd AS (SELECT * REPLACE ({CODES} AS barcode, {HERBARIA} AS herbarium_code) FROM specimens),
tidied AS (SELECT * REPLACE ({_TIDY} AS barcode, {_codes_sql('herbarium_code')}, {_codes_sql('institute')}) FROM odd),
usable AS (SELECT * FROM tidied WHERE recorded_by IS NOT NULL AND colnum IS NOT NULL),
finished AS ({merged_sql('usable', ', '.join(EXPERT_KEYS), f"{EXPERT_FIRST}, (det_year IS NULL), -det_year, (accepted_name IS NULL), accepted_name, {TIE}",
                         join=R.FINAL_ALL, whole=R.FINAL_WHOLE)}
  UNION ALL BY NAME SELECT * FROM tidied WHERE recorded_by IS NULL OR colnum IS NULL)"""


def _finished(spark, folder):
    odd = specimens(spark, folder).withColumns({"barcode": F.expr(CODES), "herbarium_code": F.expr(HERBARIA)})
    return finish(odd, ORDER)


@query("final_cleaning", with_view(CTES, select=tidy_sql("finished")))
def final_cleaning(spark, folder):
    return tidy(_finished(spark, folder).clean)


@query("final_to_check", with_view(CTES, select=f"SELECT {KEYS_SQL}, barcode FROM tidied WHERE len(list_filter(string_split(barcode, ', '), lambda t: regexp_matches(t, '^[0-9]'))) > 0"))
def final_to_check(spark, folder):
    return _finished(spark, folder).to_check.select("k_order", "k_line", "k_part", "k_supp", "barcode")
