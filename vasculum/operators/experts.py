"""Integration of expert determinations, which overrule what the master table says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.names import surname
from vasculum.functions.nulls import blank_to_null, normalise_nulls
from vasculum.functions.values import tokens_of
from vasculum.operators import rules as R
from vasculum.operators.filters import clear_surname_prefix, has_collector_and_number, require, split_usable_key
from vasculum.operators.groups import Parts, attach, materialise, number_in_group, together, with_group_values
from vasculum.operators.merge import ascending_nulls_last, first, last, merge_group, merge_some, newest_first, size
from vasculum.operators.premerge import explode_barcodes, merge_sets, present
from vasculum.schema import DEFAULT_SEPARATOR, EXPERT_KEYS


def synthetic_barcodes(df: DataFrame, order: list[str]) -> DataFrame:
    """Number the records of a determiner where the expert gave no barcode."""
    who = df.withColumn("_who", surname(F.col("det_by")))
    numbered = number_in_group(who, ["_who"], order, "_number")
    made = F.concat(F.col("_who"), F.lit("_det_"), F.col("_number").cast("string"))
    return numbered.withColumn("barcode", F.coalesce(F.col("barcode"), made)).drop("_who", "_number")


def self_deduplicate(master: DataFrame, order: list[str], keep: list[str] = ()) -> DataFrame:
    """Merge master records of the same collector and number; records without either
    cannot be compared and stay as they are."""
    rank = [*ascending_nulls_last("status"), *newest_first(), *map(F.col, order)]
    table = present(master, R.self_merge(), [*order, *keep])
    merged, others = merge_some(master, EXPERT_KEYS, rank, table, has_collector_and_number())
    return merged.unionByName(others.select(*merged.columns))


def _origin_first() -> Column:
    return F.when(F.col("origin") == "EXP", 0).otherwise(1)


def integrate_expert(
    master: DataFrame, expert: DataFrame, order: list[str], keep: list[str] = ()
) -> DataFrame:
    """Expert records into the master table: by barcode, then by collector and number.

    Records that share a barcode become one, named by the expert and placed by the
    collection. After that an expert record with the same collector and number as a
    master record passes on its determination (and coordinates, if it has any) to it.
    """
    with_coordinates = "ddlat" in expert.columns
    expert = require(normalise_nulls(expert), ["accepted_name"])
    master = self_deduplicate(clear_surname_prefix(normalise_nulls(master)), order, keep)
    both = explode_barcodes(
        expert.withColumn("origin", F.lit("EXP")).unionByName(
            master.withColumn("origin", F.lit("MASTER")), allowMissingColumns=True
        )
    )
    rank = [_origin_first(), *newest_first(), *map(F.col, order)]
    single = present(both, R.expert_barcode_merge(with_coordinates), [*order, *keep, "barcode_split"])
    by_barcode, no_barcode = merge_some(both, ["barcode_split"], rank, single, F.col("barcode_split").isNotNull())
    whole = present(by_barcode, R.expert_set_merge(), [*order, *keep])
    merged = merge_sets(by_barcode, [*rank, F.col("barcode_split")], whole, stored=True)
    merged = merged.unionByName(no_barcode.select(*merged.columns))

    usable, others = split_usable_key(merged)
    sides = {
        "_experts": F.count_if(F.col("origin") == "EXP"),
        "_masters": F.count_if(F.col("origin") == "MASTER"),
    }
    sided = materialise(with_group_values(usable, EXPERT_KEYS, sides).withColumn("_row", F.monotonically_increasing_id()))
    matched = (F.col("_experts") > 0) & (F.col("_masters") > 0)
    alone = sided.filter(~matched).drop(*sides, "_row")
    pairs = sided.filter(matched).drop(*sides)
    patched = apply_patches(pairs.filter(F.col("origin") == "MASTER"), patches_by_number(pairs, rank, with_coordinates))
    return (
        alone.unionByName(patched.select(*alone.columns)).unionByName(others).drop("origin")
    )


def patches_by_number(pairs: DataFrame, rank: list[Column], with_coordinates: bool) -> DataFrame:
    """What the experts change, one row for each collector and number that both sides have, with the `_row` of the
    master record concerned: the last one that has a barcode, or the last one if none has. `pairs` are read from files."""
    is_master = F.col("origin") == "MASTER"
    marked = pairs.withColumns({
        "_coded": F.when(is_master & F.col("barcode").isNotNull(), F.col("_row")), "_any": F.when(is_master, F.col("_row")),
    })
    table = {c: r for c, r in R.expert_patch(with_coordinates).items() if c != "barcode"} | {"_coded": last(), "_any": last()}
    patches = merge_group(marked, EXPERT_KEYS, [*rank, F.col("barcode")], table, stored=True)
    return patches.withColumn("_row", F.coalesce("_coded", "_any")).drop("_coded", "_any")


def apply_patches(targets: DataFrame, patches: DataFrame) -> DataFrame:
    """The records with the patches of their `_row`: the patch's value wins where it has one. Whether a record has
    a barcode does not matter; it gets the expert's."""
    renamed = patches.withColumnsRenamed({c: c + "_exp" for c in patches.columns if c != "_row"})
    joined = targets.join(renamed, "_row", "left")
    patched = F.col("expert_det_exp").isNotNull()
    changed = {
        c: F.coalesce(F.col(c + "_exp"), F.col(c))
        for c in patches.columns
        if c in targets.columns and c != "_row"
    }
    added = blank_to_null(F.concat_ws(DEFAULT_SEPARATOR, "barcode", F.nullif(F.col("new_barcode_exp"), F.col("barcode"))))
    changed["barcode"] = F.when(patched, added).otherwise(F.col("barcode"))
    changed["source_id"] = F.when(
        patched, F.concat_ws(DEFAULT_SEPARATOR, "source_id", F.lit("specialist"))
    ).otherwise(F.col("source_id"))
    return joined.withColumns(changed).select(*targets.columns)


def expert_matches(master: DataFrame, expert: DataFrame, order: list[str]) -> DataFrame:
    """What each expert record meets in the master table, before anything is changed: the columns of `order`, which name the
    record; `matched_by`; and `m_<column>`, the first master record it meets.

    matched_by is `refused` without an accepted name, else `barcode` if one of its barcodes is a master record's, else `number` if collector,
    prefix, number and suffix are, else `nothing`. A refused record stops an integration; the others show what it will do.
    """
    master = clear_surname_prefix(normalise_nulls(master))
    expert = normalise_nulls(expert)
    name = F.struct(*order)
    asked = expert.select(*order, *EXPERT_KEYS, "barcode", F.col("accepted_name").isNull().alias("_refused"))
    codes = explode_barcodes(master.select(*order, "barcode"), "_code").filter("_code is not null").groupBy("_code").agg(F.min(name).alias("_at"))
    by_code = explode_barcodes(asked.filter(~F.col("_refused")), "_code").join(codes, "_code").groupBy(*order).agg(F.min("_at").alias("_by_code"))
    usable, _ = split_usable_key(master)
    numbers = usable.groupBy(*EXPERT_KEYS).agg(F.min(name).alias("_by_number"))
    joined = attach(asked, numbers, EXPERT_KEYS)
    joined = attach(joined, by_code, order)
    by_number = F.when(has_collector_and_number(), F.col("_by_number"))
    how = (
        F.when(F.col("_refused"), "refused").when(F.col("_by_code").isNotNull(), "barcode")
        .when(by_number.isNotNull(), "number").otherwise("nothing")
    )
    met = F.when(~F.col("_refused"), F.coalesce("_by_code", by_number))
    return joined.select(*order, how.alias("matched_by"), *[met[c].alias("m_" + c) for c in order])


def integrate_expert_by_number(
    master: DataFrame, expert: DataFrame, order: list[str],
    names: bool = True, coordinates: bool = True, keep: list[str] = (),
) -> DataFrame:
    """Expert records without barcodes, matched by collector and number. The expert
    gives names, coordinates or both; records that match nothing are appended."""
    if not names and not coordinates:
        raise ValueError("an expert file must bring names or coordinates")
    expert = require(expert, ["recorded_by", "colnum", "det_by", "det_year"])
    master = clear_surname_prefix(master)
    every = master.withColumn("origin", F.lit("MASTER")).unionByName(expert.withColumn("origin", F.lit("EXP")), allowMissingColumns=True)
    rank = [_origin_first(), *newest_first(), *map(F.col, order)]
    table = present(every, R.by_number_merge(names, coordinates), [*order, *keep])
    # A record that meets no other stays as it was: what its rules would change or leave out comes along beside them.
    rest = [c for c in every.columns if c not in table and c != "origin"]
    changed = [c for c, rule in table.items() if rule.kind == "const"]
    own = {"_own_" + c: first(c) for c in [*rest, *changed] if c in every.columns}
    single = F.col("_n") == 1
    values = {c: F.when(single, F.col("_own_" + c) if c in every.columns else F.lit(None)).otherwise(F.col(c)) for c in changed}
    values |= {c: F.when(single, F.col("_own_" + c)) for c in rest}
    # All that meets has one collector.
    parts, merged, untouched = Parts(every, ["recorded_by"]), [], []
    for rows in parts.each():
        of_master, of_expert = (rows.filter(F.col("origin") == side) for side in ("MASTER", "EXP"))
        numbered = of_master.filter(F.col("colnum").isNotNull())
        # One row per collector; whether it is broadcast is left to its measured size.
        collectors = of_expert.select("recorded_by").distinct()
        both = numbered.join(collectors, "recorded_by", "left_semi").unionByName(of_expert)
        merged.append(merge_group(both, EXPERT_KEYS, rank, table | own | {"_n": size()}).withColumns(values).select(*table, *rest))
        others = numbered.join(collectors, "recorded_by", "left_anti").unionByName(of_master.filter(F.col("colnum").isNull()))
        untouched.append(parts.written(others.drop("origin")))
    return together(merged).unionByName(together(untouched), allowMissingColumns=True)


def update_by_barcode(
    master: DataFrame, expert: DataFrame, order: list[str], key: list[str]
) -> DataFrame:
    """Overwrite the determination of every master record that has one of an expert
    record's barcodes; append expert records that match none, and those without a barcode. `key` identifies a
    master record, `order` ranks expert records (the newest wins). A missing name, determiner or year fails the job."""
    parts = Parts(master, key)
    expert = parts.written(require(expert, ["accepted_name", "det_by", "det_year"]))
    codes = ["barcode", "accepted_name", "det_by", "det_year", "prefix", "ddlat", "ddlong"]
    codes = [c for c in codes if c in expert.columns]
    coded = expert.filter(F.col("barcode").isNotNull())
    offers = explode_barcodes(coded, "_code").select(
        "_code", F.struct(*newest_first(), *[F.col(c).alias("o_" + c) for c in order]).alias("_rank"),
        F.struct(*codes).alias("_offer"),
    )
    best_per_code = offers.groupBy("_code").agg(
        F.min_by("_offer", "_rank").alias("_offer"), F.min("_rank").alias("_rank")
    )
    wanted = explode_barcodes(parts.rows.select(*key, "barcode"), "_code").filter(F.col("_code").isNotNull())
    best = (
        wanted.join(best_per_code, "_code")
        .groupBy(*key)
        .agg(F.min_by("_offer", "_rank").alias("_offer"))
    )
    hit = F.col("_offer").isNotNull()
    new = {c: F.when(hit, F.col("_offer")[c]).otherwise(F.col(c)) for c in ("accepted_name", "det_by", "det_year", "prefix") if c in codes}
    new |= {c: F.coalesce(F.col("_offer")[c], F.col(c)) for c in ("ddlat", "ddlong") if c in codes}
    cell = F.array_join(
        F.array_distinct(
            F.concat(tokens_of(F.col("_offer.barcode"), DEFAULT_SEPARATOR), tokens_of(F.col("barcode"), DEFAULT_SEPARATOR))
        ),
        DEFAULT_SEPARATOR,
    )
    new |= {
        "barcode": F.when(hit, cell).otherwise(F.col("barcode")),
        "status": F.when(hit, F.lit("ACCEPTED")).otherwise(F.col("status")),
        "expert_det": F.when(hit, F.lit("A_expert_det_file")).otherwise(F.col("expert_det")),
    }
    known = wanted.select("_code").distinct()
    codes_of = explode_barcodes(coded, "_code")
    found = codes_of.join(known, "_code", "left_semi").select(*order).distinct()
    unmatched = parts.written(expert.join(found, order, "left_anti"))
    theirs, updated = Parts(best, key, number=parts.number if parts.many else 1), []
    for rows, those in zip(parts.each(every=True), theirs.each(every=True), strict=True):
        updated.append(parts.written(rows.join(those, key, "left").withColumns(new).drop("_offer")))
    return together(updated).unionByName(unmatched, allowMissingColumns=True)
