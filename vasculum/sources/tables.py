"""The master table and its backlogs, quarantine tables and corrections."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from vasculum.functions.nulls import denormalise_nulls, normalise_nulls
from vasculum.sources.readers import conform_master, read_delimited

TABLES = ["master", "indet", "coord"]
#: The column that says which set of a store's version a record is in.
SET = "store_set"
MANIFEST = "number long, version string, predecessor string, folder string, counts map<string, long>"


def run_stamp(user: str, moment: str) -> Column:
    """`user_YYYY-MM-DD_HH-MM-SS` in UTC. The moment is a run parameter, so a repeated
    task writes the same value."""
    return F.lit(f"{user}_{moment}")


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """A `;`-separated master or backlog file with sentinels for nulls. Line breaks in cells are kept."""
    return conform_master(normalise_nulls(read_delimited(spark, path, ";", multiline=True)))


def write_csv(df: DataFrame, path: str, na_value: int | None = None, mode: str = "errorifexists") -> None:
    """`;`-separated text; with `na_value`, nulls become that sentinel."""
    out = df if na_value is None else denormalise_nulls(df, na_value)
    out.write.option("header", True).option("sep", ";").option("escape", '"').mode(mode).csv(path)


def append_quarantine(df: DataFrame, path: str, stamp: Column, name: str = "records") -> None:
    """Add a set of set-aside records to a quarantine table, in a folder of the run's stamp and the set's name, which a repeated run
    writes anew. Sets of one run need names of their own."""
    marked = df.withColumns({"quarantined": stamp, "quarantine_set": F.lit(name)}).write.mode("overwrite")
    marked.option("partitionOverwriteMode", "dynamic").partitionBy("quarantined", "quarantine_set").parquet(path)


def _manifests(spark: SparkSession, root: str) -> list[Row]:
    """The manifests of a store, oldest first; a row each."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/manifests/*").collect()  # one row a run
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r for r in rows if r.number is not None), key=lambda r: r.number)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions of the store, oldest first as their manifests follow each other, whatever their names and file times."""
    return [r.version for r in _manifests(spark, root)]


def _manifest(spark: SparkSession, root: str, version: str | None) -> Row | None:
    known = _manifests(spark, root)
    if version is None:
        return known[-1] if known else None
    found = [r for r in known if r.version == version]
    if not found:
        raise ValueError(f"no version {version} in {root}")
    return found[-1]


def read_set(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """One set of records (a table, a backlog or what was set aside) of the newest (or a given) version, as it was written."""
    at = _manifest(spark, root, version)
    if at is None or name not in at.counts:
        raise ValueError(f"no set {name} in {root}")
    return spark.read.parquet(f"{root}/data/{at.folder}").filter(F.col(SET) == name).drop(SET)


def read_store(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame] | None:
    """Master and backlogs of the newest (or a given) version; None for a new store."""
    if _manifest(spark, root, version) is None:
        return None
    return {t: conform_master(read_set(spark, root, t, version), keep=["record_id"]) for t in TABLES}


def write_store(
    tables: dict[str, DataFrame], root: str, version: str, check: Callable[[dict[str, int]], None] = lambda counts: None
) -> dict[str, int]:
    """A new version of the store, beside the older ones, which so are the backups; returns the rows of each set.

    All sets are written in one pass, to a folder of this attempt. The manifest is written last: it names the folder, the rows of each
    set and the version before, and only with it the version is there, so a run that broke off leaves nothing that is read and can be
    repeated under the same name. `check` gets the rows of each set and may raise, before the manifest is written. Manifests are numbered and a
    number can be taken once: of two runs that follow the same version, one fails.
    """
    every = None
    for name, table in tables.items():
        marked = table.drop(SET).withColumn(SET, F.lit(name))
        every = marked if every is None else every.unionByName(marked, allowMissingColumns=True)
    spark = every.sparkSession
    before = _manifest(spark, root, None)
    folder, seen = uuid.uuid4().hex, Observation()
    rows = every.observe(seen, *[F.count_if(F.col(SET) == n).alias("n_" + n) for n in tables])
    rows.write.partitionBy(SET).parquet(f"{root}/data/{folder}")
    counts = {n: seen.get["n_" + n] for n in tables}
    check(counts)
    number = before.number + 1 if before else 1
    row = (number, version, before.version if before else None, folder, counts)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{root}/manifests/{number:09d}")
    return counts


def apply_corrections(failed: DataFrame, corrections: DataFrame, columns: list[str], key: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(records corrected by hand, records still to correct). `corrections` holds the
    key and corrected columns; an empty cell leaves the value as it was."""
    marked = corrections.select(key, *[F.col(c).alias("_new_" + c) for c in columns], F.lit(True).alias("_seen"))
    joined = failed.join(marked.dropDuplicates([key]), key, "left")
    fixed = joined.withColumns({c: F.coalesce("_new_" + c, c) for c in columns})
    seen = F.col("_seen").isNotNull()
    return (
        fixed.filter(seen).select(*failed.columns),
        fixed.filter(~seen).select(*failed.columns),
    )


def conservation(before: DataFrame, *parts: DataFrame) -> DataFrame:
    """Row counts before and after a split: `before`, `after`, `conserved`."""
    counts = before.agg(F.count(F.lit(1)).alias("before"), F.lit(0).cast("long").alias("after"))
    for part in parts:
        counts = counts.unionByName(
            part.agg(F.lit(0).cast("long").alias("before"), F.count(F.lit(1)).alias("after"))
        )
    return counts.agg(F.sum("before").alias("before"), F.sum("after").alias("after")).withColumn(
        "conserved", F.col("before") == F.col("after")
    )


class Ledger:
    """Row counts at the splits, unions and merges of a run, taken by the jobs through which the rows pass anyway; rows whose job Spark
    left out or replanned without its count are counted by a job of their own."""

    def __init__(self):
        self.steps: dict[str, tuple[list[tuple[Observation, DataFrame]], list[tuple[Observation, DataFrame]]]] = {}

    def _seen(self, step: str, side: int, df: DataFrame, rows: Column | None) -> DataFrame:
        observation = Observation()
        count = (F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))).cast("long").alias("rows")
        self.steps.setdefault(step, ([], []))[side].append((observation, df.agg(count)))
        return df.observe(observation, count)

    @staticmethod
    def _rows(observation: Observation, counted: DataFrame) -> int:
        try:
            return observation.get["rows"]
        except (Py4JJavaError, KeyError):  # its job ended without a count
            return counted.first()["rows"]

    def before(self, step: str, df: DataFrame) -> DataFrame:
        """`df`, whose rows come into the step."""
        return self._seen(step, 0, df, None)

    def after(self, step: str, df: DataFrame, rows: Column | None = None) -> DataFrame:
        """`df`, whose rows come out of the step; each stands for `rows` that came in, if given."""
        return self._seen(step, 1, df, rows)

    def counts(self) -> list[tuple[str, int, int, bool]]:
        """(step, before, after, conserved). Only once all that was counted has been written: it waits for the counts."""
        out = []
        for step, sides in self.steps.items():
            before, after = (sum(self._rows(*counted) for counted in side) for side in sides)
            out.append((step, before, after, before == after))
        return out

    def require(self) -> None:
        """Fail if rows were lost or doubled at a step."""
        wrong = [f"{step}: {before} rows before, {after} after" for step, before, after, same in self.counts() if not same]
        if wrong:
            raise ValueError("; ".join(wrong))
