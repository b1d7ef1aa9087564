"""Resolution of taxa, collectors and countries against authority tables.

The pattern is always the same: one answer for each name of the authority, joined to the rows, which are read once.
Only collectors are reduced to distinct names first, since their answer depends on their labels. Authority tables are joined without a broadcast
hint: Spark broadcasts them when their measured size allows, and otherwise shuffles,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vasculum.functions.names import given_names, initials, standardise_name, surname
from vasculum.functions.values import taxon_key
from vasculum.operators.groups import materialise

# Outcomes of a name search, and the address of a name's record.
ACCEPTED, SYNONYM = "ACCEPTED", "SYNONYM"
NOT_FOUND, NOT_DETERMINED = "not found in POWO", "not det"
NAME_RECORD = "https://ipni.org/n/"
# ------------------------------- end of fixed values
#: Groups over which rows without a name are spread.
SPREAD = 10_000


def _with_names(df: DataFrame, answers: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of one answer per name. Rows without a name match nothing; a second key spreads them
    over the tasks, so that they do not all travel to one."""
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    known = answers.select(F.col(key).alias("_known"), *columns, F.lit(0).cast("long").alias("_none")).filter("_known is not null")
    asked = df.withColumn("_spread", spread)
    return asked.join(known, (asked[key] == known["_known"]) & (asked["_spread"] == known["_none"]), "left").drop("_known", "_none", "_spread")


def resolve_taxa(df: DataFrame, backbone: DataFrame, distribution: bool = False) -> DataFrame:
    """Accepted name, its author and the name record of each taxon.

    `backbone`: id, genus, epithet, accepted (boolean), name, author, accepted_id
    (and native_to with `distribution`). A synonym takes name and author of its
    accepted taxon but keeps its own record.
    """
    out = df.withColumn("_taxon", taxon_key(F.col("genus"), F.col("specific_epithet")))
    target = ["name", "author"] + (["native_to"] if distribution else [])
    accepted = backbone.select(
        F.col("id").alias("_accepted_id"), *[F.col(c).alias("_acc_" + c) for c in target]
    )
    known = backbone.groupBy(taxon_key(F.col("genus"), F.col("epithet")).alias("_taxon")).agg(
        # Homonyms: the accepted one first, then the smallest id.
        F.min_by(
            F.struct("id", "accepted", "accepted_id", *target), F.struct(~F.col("accepted"), "id")
        ).alias("_hit")
    )
    matched = known.select("_taxon", "_hit.*").join(accepted, F.col("accepted_id") == F.col("_accepted_id"), "left")

    def of_accepted(c: str) -> Column:
        return F.when(F.col("accepted"), F.col(c)).otherwise(F.col("_acc_" + c))

    answers = matched.select(
        "_taxon",
        F.when(F.col("accepted"), ACCEPTED).otherwise(SYNONYM).alias("status"),
        F.when(F.col("accepted"), F.col("_taxon")).otherwise(F.col("_acc_name")).alias("accepted_name"),
        of_accepted("author").alias("ipni_species_author"),
        F.concat(F.lit(NAME_RECORD), F.col("id").cast("string")).alias("ipni_no"),
        *([of_accepted("native_to").alias("native_to")] if distribution else []),
    )
    columns = [c for c in answers.columns if c != "_taxon"]
    resolved = _with_names(out.drop(*columns), answers, "_taxon", columns)
    return resolved.withColumn(
        "status",
        F.when(F.col("_taxon").isNull(), NOT_DETERMINED).otherwise(F.coalesce("status", F.lit(NOT_FOUND))),
    ).drop("_taxon")


def resolve_expert_taxa(df: DataFrame, backbone: DataFrame) -> DataFrame:
    """Author, name record and year of publication of an expert's accepted names."""
    known = backbone.groupBy(F.col("name").alias("accepted_name")).agg(
        F.min_by(F.struct("author", "id", "pub_year"), F.struct(~F.col("accepted"), "id")).alias("_hit")
    )
    answers = known.select(
        "accepted_name",
        F.col("_hit.author").alias("ipni_species_author"),
        F.concat(F.lit(NAME_RECORD), F.col("_hit.id").cast("string")).alias("ipni_no"),
        F.col("_hit.pub_year").alias("ipni_pub"),
    )
    columns = ["ipni_species_author", "ipni_no", "ipni_pub"]
    return _with_names(df.drop(*columns), answers, "accepted_name", columns)


def match_botanists(asked: DataFrame, botanists: DataFrame) -> DataFrame:
    """Candidates for each collector: same surname, and initials that begin with the
    collector's."""
    people = botanists.withColumn("_standard", standardise_name(F.col("name"))).select(
        F.col("link_id"), F.col("name"), "dobirth", "dodeath", "geo_col", "wiki_url",
        surname(F.col("_standard")).alias("_surname"),
        F.coalesce(given_names(F.col("_standard")), F.lit("")).alias("_initials"),
    )
    collectors = asked.withColumns(
        {"_surname": surname(F.col("recorded_by")), "_wanted": initials(F.col("recorded_by"))}
    )
    return (
        collectors.join(people, "_surname")
        .filter(F.col("_initials").startswith(F.col("_wanted")))
        .drop("_wanted", "_initials")
    )


def resolve_collectors(df: DataFrame, botanists: DataFrame, order: list[str]) -> DataFrame:
    """Replace collectors by the one botanist their name, label and year point to.

    `botanists`: link_id, name, dobirth, dodeath, geo_col, wiki_url. Of the candidates
    teams are dropped, entries in `Surname, Given` form preferred, then those whose
    first given name is on the original label. Entries of one person (same surname and
    first given name) are united under the longest name, and must have been alive in
    the collecting year where dates are known. Unless exactly one is left the
    standardised name stays.
    """
    df = materialise(df)  # read twice; standardised names are dear to compute
    latest = F.struct(*order)
    asked = (
        df.filter(F.col("recorded_by").isNotNull())
        .groupBy("recorded_by")
        .agg(F.max_by(F.struct("col_year", "orig_recby"), latest).alias("_label"))
        .select("recorded_by", "_label.*")
    )
    commas = F.regexp_count(F.col("name"), F.lit(","))
    candidates = (
        match_botanists(asked, botanists)
        .dropDuplicates(["recorded_by", "link_id"])
        .filter(commas < 2)
        .withColumn("_comma", commas > 0)
    )
    label = F.filter(
        F.split(F.translate(F.coalesce("orig_recby", F.lit("")), ",.", "  "), " "), lambda t: t != ""
    )
    first_given = F.split_part(F.coalesce(given_names(F.col("name")), F.lit("")), F.lit(" "), F.lit(1))
    candidates = candidates.withColumn("_given", first_given).withColumn(
        "_vote", F.exists(label, lambda t: F.contains(F.col("_given"), t))
    )
    words = F.struct(F.size(F.split("name", " ")), F.length("name"), F.col("name"), F.col("link_id"))
    details = ["dobirth", "dodeath", "geo_col", "wiki_url"]
    # Entries of one person, under the longest name; gaps are filled from the others.
    persons = candidates.groupBy("recorded_by", "col_year", "_comma", "_vote", "_surname", "_given").agg(
        F.max_by("name", words).alias("name"),
        F.count(F.lit(1)).alias("_entries"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), words)).alias(c) for c in details],
    )
    # A collector has few candidate persons, so the verdict is one small aggregate.
    person = F.struct("_comma", "_vote", "_entries", "name", *details)
    verdict = persons.groupBy("recorded_by", "col_year").agg(F.collect_list(person).alias("_persons"))
    year = F.col("col_year")

    def alive(p: Column) -> Column:
        after_birth = F.coalesce(p["dobirth"] <= year, F.lit(True))
        before_death = F.coalesce(p["dodeath"] >= year, F.lit(True))
        return after_birth & before_death

    several = F.aggregate("_persons", F.lit(0).cast("long"), lambda n, p: n + p["_entries"]) > 1
    formal = F.when(several, F.filter("_persons", lambda p: p["_comma"])).otherwise(F.col("_persons"))
    verdict = verdict.withColumn("_persons", formal)
    voted = F.filter("_persons", lambda p: p["_vote"])
    verdict = verdict.withColumn(
        "_persons", F.when((F.size("_persons") > 1) & (F.size(voted) > 0), voted).otherwise(F.col("_persons"))
    )
    verdict = verdict.withColumn("_persons", F.filter("_persons", alive))
    answers = verdict.filter(F.size("_persons") == 1).select(
        "recorded_by", F.col("_persons")[0].alias("_one")
    ).select(
        "recorded_by", F.col("_one.name").alias("huh_name"), "_one.geo_col", "_one.wiki_url"
    )
    columns = ["huh_name", "geo_col", "wiki_url"]
    out = df.drop(*columns).withColumn("recby_regex", F.col("recorded_by"))
    resolved = _with_names(out, answers, "recorded_by", columns)
    name = F.coalesce("huh_name", "recby_regex")
    return resolved.withColumns({"huh_name": name, "recorded_by": name})


def country_crossfill(df: DataFrame, countries: DataFrame) -> DataFrame:
    """ISO2, ISO3 and short name of each country, from whichever of name and code the
    record has. `countries`: alias, iso2, iso3, name_short; unknown countries are null."""
    if "country_id" not in df.columns:
        df = df.withColumn("country_id", F.lit(None).cast("string"))
    by_alias = countries.groupBy(F.lower("alias").alias("_alias")).agg(
        F.min_by(F.struct("iso2", "iso3", "name_short"), F.struct("iso2", "iso3")).alias("_c")
    )
    by_code = countries.groupBy(F.col("iso2").alias("_code")).agg(
        F.min_by(F.struct("iso3", "name_short"), F.struct("iso3", "name_short")).alias("_i")
    )
    named = df.drop("country_iso3").withColumn("_alias", F.lower("country"))
    joined = _with_names(named, by_alias, "_alias", ["_c"]).drop("_alias")
    joined = joined.withColumn("country_id", F.coalesce("country_id", "_c.iso2")).withColumn(
        "_code", F.col("country_id")
    )
    joined = _with_names(joined, by_code, "_code", ["_i"]).drop("_code")
    return joined.withColumns(
        {
            "country_iso3": F.coalesce(
                F.col("_c.iso3"), F.when(F.col("country").isNull(), F.col("_i.iso3"))
            ),
            "country": F.coalesce("country", "_i.name_short"),
        }
    ).drop("_c", "_i")
