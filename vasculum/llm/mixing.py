"""Mixing sources to target weights by hash thresholds.

Every document gets a hash key. Words are summed by source and by the first digits of the key, and in the running sums of these
histograms the bucket is found in which a budget ends. Only that bucket is counted again, by the next digits, until
one document is left in it. What lies under the threshold is taken, so the mix is a filter and nothing is sorted.
A document that is taken twice lies under the thresholds of both its source's budgets, which are nested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vasculum.llm.storage import stored

#: Hexadecimal digits of a document's key that come from its id and text; the digits behind them tell repeated rows apart.
KEY_DIGITS = 20
ROW_DIGITS = 16
#: Digits by which a histogram is refined: 4,096 buckets.
STEP = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Above every key.
ALL = "g"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Rows (source, source_size, target) from (source, source_size).

    Sources in the order of their code points, null last, weigh `weights`, repeating, and share `share` times all sizes. A target
    stops at `most` times its source's size and the excess goes to the others by weight: in the end those that have not
    stopped get a common level times their weight. Targets are 0 if all sizes are; with `share` above `most` all stop. One row a
    source is all that this touches.
    """
    rows = sizes.select("source", F.col("source_size").cast("double").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    rows = rows.withColumns({"weight": weight, "cap": F.col("source_size") * most, "rank": rank, "total": F.sum("source_size").over(everything) * share})
    rows = rows.withColumn("stops_at", F.col("cap") / F.col("weight"))
    by_stop = everything.orderBy("stops_at", "rank")
    before, after = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    # The first source that does not stop at the level which those before it leave.
    common = F.min_by("level", F.when(F.col("stops_at") >= F.col("level"), F.struct("stops_at", "rank"))).over(everything)
    target = F.least("cap", F.coalesce(F.col("weight") * common, F.col("cap")))
    return rows.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def _thresholds(keyed: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """Rows (source, cuts): the keys under which a document is taken for the first, second ... time.

    keyed: (source, size, key). The words under a threshold are as near to its budget as hash order allows: half a document at most.
    """
    budgets = targets.select("source", "source_size", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("k"), "target")
    budgets = budgets.withColumn("left", F.col("target") - F.col("k") * F.col("source_size"))
    edge = F.when(F.col("left") <= 0, "").when(F.col("left") >= F.col("source_size"), ALL)
    budgets = stored(budgets.select("source", "k", "left", F.lit("").alias("prefix"), edge.alias("cut")), "budgets")
    done, open_ = [budgets.filter("cut is not null")], budgets.filter("cut is null")
    for digits in range(STEP, KEY_DIGITS + ROW_DIGITS + STEP, STEP):
        if open_.isEmpty():
            break
        # The first histogram covers all rows, each further one the rows of the boundary buckets.
        inside = keyed
        if digits > STEP:
            edges = open_.select(F.col("source").alias("_s"), F.col("prefix").alias("_p")).distinct()
            inside = keyed.join(edges, F.col("source").eqNullSafe(F.col("_s")) & (F.substring("key", 1, digits - STEP) == F.col("_p")), "left_semi")
        counts = inside.groupBy("source", F.substring("key", 1, digits).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        counts = counts.withColumnRenamed("source", "_s")
        own = F.col("source").eqNullSafe(F.col("_s")) & F.startswith("bucket", "prefix")
        along = Window.partitionBy("source", "k").orderBy("bucket")  # at most 4,096 buckets
        sums = open_.join(counts, own).withColumn("upto", F.sum("words").over(along)).filter(F.col("upto") > F.col("left"))
        edge = F.min(F.struct("bucket", "upto", "words", "rows")).alias("edge")
        found = sums.groupBy("source", "k", "left").agg(edge).select(
            "source", "k", (F.col("left") - F.col("edge.upto") + F.col("edge.words")).alias("left"),
            F.col("edge.bucket").alias("prefix"), F.col("edge.words").alias("words"), F.col("edge.rows").alias("rows"),
        )
        nearer = F.when(F.col("words") - F.col("left") < F.col("left"), F.concat("prefix", F.lit(ALL))).otherwise(F.col("prefix"))
        alone = (F.col("rows") == 1) | F.lit(digits >= KEY_DIGITS + ROW_DIGITS)
        found = stored(found.select("source", "k", "left", "prefix", F.when(alone, nearer).alias("cut")), "budgets")
        done.append(found.filter("cut is not null"))
        open_ = found.filter("cut is null")
    cuts = done[0]
    for more in done[1:]:
        cuts = cuts.unionByName(more)
    return cuts.groupBy("source").agg(F.collect_list("cut").alias("cuts"))  # `most` entries each


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken), one for each row of `docs`.

    size counts the words of the whole text (null: 0); copies says how often the mix takes the document, at most `most` times, and
    taken is copies times size. A source's taken words differ from its target by half a document at most, the one at the
    threshold, for each of its budgets. The key is a hash of seed, id and text, so the same rows give the same mix on any cluster;
    rows that repeat id and text share it and are told apart by their number, so that as many of them are taken as the budget has
    room for. A null source is a source of its own, a null id counts as empty text; other columns are ignored; no rows give none.
    Nothing comes to the driver, a source of any size is spread over all tasks, and documents move only to be written.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)), 1, KEY_DIGITS)
    row = F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), ROW_DIGITS, "0")
    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.concat(key, row).alias("key"),
    )
    keyed = stored(keyed, "sizes")
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "targets")
    cuts = _thresholds(keyed, targets, most)
    plan = targets.join(cuts.withColumnRenamed("source", "_c"), F.col("source").eqNullSafe(F.col("_c")))
    plan = stored(plan.select(F.col("source").alias("_s"), "source_size", "target", "cuts"), "plan")
    copies = F.size(F.filter("cuts", lambda cut: F.col("key") < cut)).cast("long")
    return keyed.join(plan, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


#: DuckDB: hash order as running sums over all documents.
SQL = r"""
with keyed as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    substr(md5('0:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 20) as key
  from documents
), sizes as (
  select source, sum(size)::double as source_size, row_number() over (order by source nulls last) - 1 as rank
  from keyed group by source
), weighed as (
  select *, [5.0, 2.0, 1.0][(rank % 3 + 1)::int]::double as weight, 2 * source_size as cap, 1.5 * sum(source_size) over () as total
  from sizes
), levels as (
  select *, cap / weight as stops_at,
    (total - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as level
  from weighed
), targets as (
  select source, source_size,
    least(cap, weight * (select arg_min(level, (stops_at, rank)) from levels where stops_at >= level)) as target
  from levels
), sums as (
  select k.doc_id, k.size, t.source_size, t.target,
    sum(k.size) over (partition by k.source order by k.key rows between unbounded preceding and current row)::double as upto
  from keyed k join targets t on k.source is not distinct from t.source
), budgets as (
  select *, least(target, source_size) as first, greatest(target - source_size, 0) as second from sums
)
select doc_id, size, source_size::bigint as source_size, target,
  size * ((upto <= first or (upto - size < first and upto - first < first - (upto - size)))::bigint
    + (upto <= second or (upto - size < second and upto - second < second - (upto - size)))::bigint) as taken
from budgets
"""
