"""Duplicate statistics and run reports: one pass over the rows each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.names import surname

# The key sets by which duplication is reported.
DUPLICATE_KEY_SETS = {
    "collector_fullnumber": ["recorded_by", "colnum_full"],
    "label_collector_fullnumber": ["orig_recby", "colnum_full"],
    "collector_fullnumber_coordinates": ["recorded_by", "colnum_full", "ddlat", "ddlong"],
    "collector_fullnumber_taxon": ["recorded_by", "colnum_full", "genus", "specific_epithet"],
    "fullnumber_taxon": ["colnum_full", "genus", "specific_epithet"],
    "fullnumber_genus": ["colnum_full", "genus"],
    "fullnumber_year_country": ["colnum_full", "col_year", "country"],
    "year_fullnumber": ["col_year", "colnum_full"],
    "number_year": ["colnum", "col_year"],
    "locality_number_year": ["locality", "colnum", "col_year"],
    "surname_number": ["coll_surname", "colnum"],
    "surname_fullnumber": ["coll_surname", "colnum_full"],
    "surname_number_year": ["coll_surname", "colnum", "col_year"],
    "surname_number_suffix_year": ["coll_surname", "colnum", "sufix", "col_year"],
    "resolved_number_suffix_year": ["huh_name", "colnum", "sufix", "col_year"],
}
CONSOLIDATION_KEY_SETS = {
    "collector_number_suffix_year_country": ["recorded_by", "colnum", "sufix", "col_year", "country_iso3"],
    "barcode": ["barcode"],
}
PREMERGE_KEY_SETS = {
    "surname_number_suffix_year_country": ["coll_surname", "colnum", "sufix", "col_year", "country_iso3"],
    "surname_fullnumber": ["coll_surname", "colnum_full"],
    "surname_number_taxon": ["coll_surname", "colnum", "genus", "specific_epithet"],
    "barcode": ["barcode"],
}
# ------------------------------- end of fixed values


def _plan(key_sets: dict[str, list[str]], derived: dict[str, str]) -> dict[str, list[str]]:
    """Which key sets must be counted from the rows, and for each those counted from its counts: a set follows from any set that
    holds its columns or what they derive from. Of several, the one with the fewest columns has the fewest groups."""

    def follows(one: str, other: str) -> bool:
        own, given = set(key_sets[one]), set(key_sets[other])
        return one != other and all(c in given or derived.get(c) in given for c in own)

    names = list(key_sets)
    # Of sets that follow from each other the first is counted.
    first = [n for n in names if not any(follows(n, m) and (not follows(m, n) or names.index(m) < names.index(n)) for m in names)]
    plan: dict[str, list[str]] = {n: [] for n in first}
    for n in names:
        if n not in plan:
            plan[min((m for m in first if follows(n, m)), key=lambda m: len(key_sets[m]))].append(n)
    return plan


def duplicate_stats(df: DataFrame, key_sets: dict[str, list[str]] = DUPLICATE_KEY_SETS) -> DataFrame:
    """For every key set, how many numbered records have a duplicate (null equals null).

    Only sets that follow from no other are counted from the rows, by grouping sets in one scan; all others from those
    counts. Both are combined on the map side, so a key held by many rows costs one row per task."""
    derived = {"coll_surname": "recorded_by"}
    numbered = df.filter(F.col("colnum").isNotNull()).withColumn("coll_surname", surname(F.col("recorded_by")))
    columns = list(dict.fromkeys(c for keys in key_sets.values() for c in keys))
    plan = _plan(key_sets, derived)

    def bits(name: str) -> int:
        # grouping_id has a bit set for every column that is left out.
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key_sets[name])

    def lookup(values: dict[str, Column]) -> Column:
        return F.create_map(*[part for name, value in values.items() for part in (F.lit(bits(name)), value)])[F.col("set_id").cast("int")]

    counted = numbered.groupingSets([[F.col(c) for c in key_sets[n]] for n in plan], *columns).agg(
        F.count(F.lit(1)).alias("rows"), F.grouping_id().alias("set_id")
    )
    duplicated = F.sum(F.when(F.col("rows") > 1, F.col("rows")).otherwise(0)).alias("duplicated_records")
    out = counted.groupBy(lookup({n: F.lit(n) for n in plan}).alias("key_set")).agg(duplicated)
    if not any(plan.values()):
        return out

    # The outer explode infers no condition on the sets, which would be pushed under the counts and have them made twice.
    following = lookup({n: F.array(*[F.lit(f) for f in fs]).cast("array<string>") for n, fs in plan.items()})
    rolled = counted.withColumn("key_set", F.explode_outer(following)).filter(F.col("key_set").isNotNull())

    def value(column: str) -> Column:
        held = F.col(column)
        if column in derived and derived[column] in columns:  # where it is no key of the counts, it is made from what is
            held = F.when(F.col("set_id").bitwiseAND(1 << (len(columns) - 1 - columns.index(column))) == 0, held).otherwise(surname(F.col(derived[column])))
        users = [f for fs in plan.values() for f in fs if column in key_sets[f]]
        return F.when(F.col("key_set").isin(users), held) if users else F.lit(None)

    used = [c for c in columns if any(c in key_sets[f] for fs in plan.values() for f in fs)]
    keys = rolled.select("key_set", "rows", *[value(c).alias(c) for c in used])
    return out.unionByName(keys.groupBy("key_set", *used).agg(F.sum("rows").alias("rows")).groupBy("key_set").agg(duplicated))


def record_counts(df: DataFrame) -> DataFrame:
    """Total records, with and without a collection number."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("colnum").alias("numbered"),
        F.count_if(F.col("colnum").isNull()).alias("without_number"),
    )


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("records"))


def resolution_report(resolved_names: DataFrame, resolved: str = "huh_name") -> DataFrame:
    """Names asked for, names not resolved, and the share resolved."""
    total, missing = F.count(F.lit(1)), F.count_if(F.col(resolved).isNull())
    return resolved_names.agg(
        total.alias("names"),
        missing.alias("unresolved"),
        F.round(100 * (total - missing) / total, 4).alias("resolved_percent"),
    )


def unique_collectors(df: DataFrame) -> DataFrame:
    return df.select("recorded_by").distinct()
