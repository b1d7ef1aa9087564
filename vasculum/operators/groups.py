"""Operators over groups of rows that survive one group holding much of the table.

What does not depend on the order of rows is an aggregate, which Spark reduces on the map side, joined back to
the rows; adaptive execution splits the join where a key is hot.

What depends on order is one scan: rows are laid out by key and sorted, so that a group is a run of neighbouring rows, and
a run that is too long for a task goes on from task to task. A first pass notes what the tasks' first and last runs
hold, two rows a task; carried from task to task, this tells the second pass what came before its first run and what
follows its last one.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from py4j.java_gateway import JavaObject
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, NullType, StringType, StructType, VariantType

# What tasks run is sent along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sorted rows of a task as they are written: small Parquet files, and those that tell of the task's first or last run.
LAID = "_part int, _end int, _blob binary"
FIRST_RUN, LAST_RUN, BOTH_ENDS = 0, 1, 2
#: Bytes of rows in one of them.
PACKED_BYTES = 16_000_000
#: Rows that one task sorts, about, when a table has too many for the session's number of tasks.
TASK_ROWS = 250_000
#: Classes of keys that are counted before rows are laid out.
KEY_CLASSES = 8192
#: Bytes of files for one part: rows that come from more are laid out in parts, one after the other.
PART_BYTES = 2**31
#: The same for rows that need not be written otherwise.
STORED_PART_BYTES = 8 * PART_BYTES
#: The column by which the files of parts are kept apart.
PIECE = "_piece"


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (the warehouse's, if none is set and the session is local), set as the checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return context.getCheckpointDir()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes its shuffle files when it ends, for it leaves its rows in the shared folder."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def batches_by_rows(spark: SparkSession, short: bool) -> Iterator[None]:
    """What is run inside cuts batches for Python by their number of rows alone, if rows are so `short` (`in_runs`) that bytes are no bound:
    to heed them, Spark measures every column of the batch anew for every row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    if short:
        spark.conf.set(name, str(2**31 - 1))
    try:
        yield
    finally:
        if short:
            spark.conf.set(name, before)


def _widest(df: DataFrame) -> Column | None:
    """Bytes that the widest row takes in a batch, at most; null if nested columns leave that open."""
    kinds = [f.dataType for f in df.schema]
    if any(isinstance(t, ArrayType | MapType | StructType | VariantType) for t in kinds):
        return None
    texts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c, t in zip(df.columns, kinds, strict=True) if isinstance(t, StringType | BinaryType)]
    return F.max(reduce(lambda a, b: a + b, texts, F.lit(24 * len(kinds)).cast("long")))


def _rows_a_batch(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def remove_rows(spark: SparkSession, path: str | None) -> None:
    """Delete the rows that `in_runs` has written, when those who asked for them have written what they made of them. Their folder stays, empty."""
    if path:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for file in files.listStatus(folder):
            files.delete(file.getPath(), True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table in the cluster's shared folder: compressed Parquet, of which later steps read the columns they need.

    Neither the order of rows nor their tasks are kept.
    """
    return _written(df)[0]


def written(df: DataFrame) -> tuple[DataFrame, str | None]:
    """The same, and the folder of the rows, to be emptied (`remove_rows`) when they have been used."""
    return _written(df)


def _written(df: DataFrame, by: list[str] = (), **options: str) -> tuple[DataFrame, str | None]:
    """(the rows as they were written, in folders `by` columns if there are any, their folder or null if they are a checkpoint)."""
    spark = df.sparkSession
    folder = _shared_folder(spark)
    if any(isinstance(f.dataType, NullType) for f in df.schema):  # Parquet has no such type
        return df.checkpoint(), None
    path = f"{folder}/rows-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.options(compression="zstd", **options).partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _written_for_layout(df: DataFrame, by: list[str] = ()) -> tuple[DataFrame, str | None, bool]:
    """The same for rows that are read once or twice and removed, and whether a batch of them stays below PACKED_BYTES.

    Without dictionaries, which take more time to build than these reads save.
    """
    plain = {"parquet.enable.dictionary": "false"}
    widest, rows_a_batch = _widest(df), _rows_a_batch(df.sparkSession)
    if widest is None or rows_a_batch <= 0:
        return *_written(df, by, **plain), False
    told = Observation()
    rows, path = _written(df.observe(told, widest.alias("widest")), by, **plain)
    try:
        most = told.get["widest"]
    except AssertionError:  # the optimiser has left the rows out: there are none
        most = None
    return rows, path, most is not None and most * rows_a_batch <= PACKED_BYTES


def _checkpoints(df: DataFrame) -> dict[str, JavaObject]:
    """The folders of checkpoints from which the rows are computed, as Hadoop paths."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    rdds = [leaf.rdd() for leaf in (leaves.apply(i) for i in range(leaves.size())) if leaf.getClass().getSimpleName() == "LogicalRDD"]
    files = [rdd.getCheckpointFile().get() for rdd in rdds if rdd.getCheckpointFile().isDefined()]
    return {file: df.sparkSession._jvm.org.apache.hadoop.fs.Path(file) for file in files}


def remove_checkpoints(df: DataFrame) -> None:
    """Delete the checkpoints from which the rows are computed, when they are not read again."""
    for folder in _checkpoints(df).values():
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def _source_bytes(df: DataFrame) -> int:
    """Bytes of the files from which the rows are computed, those of a folder counted once; rows that come from elsewhere count nothing."""
    leaves, folders = df._jdf.queryExecution().optimizedPlan().collectLeaves(), {}
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            folders[leaf.relation().location().rootPaths().toString()] = int(leaf.relation().location().sizeInBytes())
    for file, folder in _checkpoints(df).items():
        folders[file] = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return sum(folders.values())


class Parts:
    """Rows whose files are so large that they are worked on in parts, one after the other: what a part's work shuffles is removed
    before that of the next is written. Rows of one key are in one part.

    Parts are folders of the written rows (`many`). Rows that are not so large are one part, and are not written.
    """

    def __init__(self, df: DataFrame, keys: list[str], stored: bool = False, number: int | None = None):
        self.spark, self.rows, self.short, self._path = df.sparkSession, df, False, None
        self.number = number or _source_bytes(df) // (STORED_PART_BYTES if stored else PART_BYTES) + 1
        self.many = self.number > 1 and not any(isinstance(f.dataType, NullType) for f in df.schema)
        if self.many:
            # Not the hash by which a part's rows are dealt to tasks and classes later.
            piece = F.pmod(F.xxhash64(F.lit("piece"), *keys), F.lit(self.number)).cast("int")
            rows, self._path, self.short = _written_for_layout(df.withColumn(PIECE, piece), [PIECE])
            self.rows = rows.select(*df.columns)

    def paths(self) -> list[str | None]:
        """The folder of each part, null if it has no rows."""
        paths = [f"{self._path}/{PIECE}={number}" for number in range(self.number)]
        places = [self.spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
        files = places[0].getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [p if files.exists(place) else None for p, place in zip(paths, places, strict=True)]

    def each(self, every: bool = False) -> Iterator[DataFrame]:
        """The parts that have rows (with `every`, all of them), one at least. A part is removed when the next is asked for: what is made of it
        must have been written by then (`written`)."""
        if not self.many:
            yield self.rows
            return
        paths, schema = self.paths(), self.rows.schema
        none = self.rows.filter(F.lit(False))
        for path in paths if every or not any(paths) else [p for p in paths if p]:
            yield self.spark.read.schema(schema).parquet(path) if path else none
            remove_rows(self.spark, path)
            if not any(paths) and not every:
                return

    def written(self, df: DataFrame) -> DataFrame:
        """What was made of a part: written if there are others."""
        return materialise(df) if self.many else df


def together(tables: list[DataFrame]) -> DataFrame:
    """The rows of tables with the same columns."""
    return reduce(DataFrame.unionByName, tables)


def same_key(left: DataFrame, right: DataFrame, keys: list[str], prefix: str = "") -> Column:
    """Key equality in which null equals null."""
    return reduce(
        lambda a, b: a & b, (left[k].eqNullSafe(right[prefix + k]) for k in keys)
    )


def attach(df: DataFrame, per_key: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join back a table with one row for each key."""
    small = per_key.withColumnsRenamed({k: "_k_" + k for k in keys})
    return df.join(small, same_key(df, small, keys, "_k_"), how).drop(*["_k_" + k for k in keys])


def with_group_values(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Add aggregates of each row's group as columns. `values` are aggregate expressions
    that do not depend on row order (use `min_by` for "the first")."""
    return attach(df, df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in values.items()]), keys)


def is_duplicate(df: DataFrame, keys: list[str], flag: str = "is_duplicate") -> DataFrame:
    """Flag every member of a group of two or more; null equals null in keys."""
    counted = with_group_values(df, keys, {"_n": F.count(F.lit(1))})
    return counted.withColumn(flag, F.col("_n") > 1).drop("_n")


def drop_duplicates_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each group in `order`."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return best.select(*keys, "_row.*").select(*df.columns)


def in_runs(df: DataFrame, keys: list[str], order: list[str], stored: bool = False) -> tuple[DataFrame, str | None, bool]:
    """The rows laid out so that those of a key are neighbours, sorted by `order`, nulls first; the folder, if any, to be emptied
    (`remove_rows`) when they have been used; and whether they are known to be short (`batches_by_rows`).

    A key's rows lie in one task, by the key's hash. Keys with more rows than a task should hold are found by a count of classes of
    keys, which reads the key columns only; their rows are laid out by ranges of key and order, so that a key goes on from task to
    task. The count reads the rows once more, so they are written out first, not computed each time; not those that are
    `stored`, that is read from files and changed row by row at most.
    """
    rows, path, short = (df, None, False) if stored else _written_for_layout(df)
    spark = df.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.xxhash64(*keys)
    class_ = F.pmod(hashed, F.lit(KEY_CLASSES))
    counts = dict(rows.groupBy(class_.alias("class")).count().collect())  # KEY_CLASSES at most

    def tasks(among: list[int]) -> list[int]:
        """The number of tasks as an argument, none if the session's number will do."""
        wanted = sum(among) // TASK_ROWS
        return [wanted] if wanted > usual else []

    every = sum(counts.values())
    most = max(_rows_a_batch(spark), every / (2 * max([usual, *tasks([every])])), 4 * every / KEY_CLASSES)
    large = [c for c, n in counts.items() if n > most]
    small = rows.filter(~class_.isin(large)) if large else rows
    small = small.repartition(*tasks([n for n in counts.values() if n <= most]), *keys)
    # Sorting by a number first hardly ever compares the keys of different runs.
    laid = small.withColumn("_hash", hashed).sortWithinPartitions("_hash", *keys, *order).drop("_hash")
    if large:
        spread = rows.filter(class_.isin(large)).repartitionByRange(*tasks([counts[c] for c in large]), *keys, *order)
        laid = laid.unionByName(spread.sortWithinPartitions(*keys, *order))
    return laid, path, short


def runs_in_parts(df: DataFrame, keys: list[str], order: list[str], stored: bool = False, short: bool = False) -> Iterator[tuple[DataFrame, bool]]:
    """The same, part by part (`Parts`): (rows laid out, whether they are short). What is made of them must have been written when the next are
    asked for; what was written for them is removed then."""
    parts = Parts(df, keys, stored)
    for rows in parts.each():
        laid, path, measured = in_runs(rows, keys, order, stored or parts.many)
        yield laid, short or parts.short or measured
        remove_rows(df.sparkSession, path)


def run_starts(columns: list[pa.Array | pa.ChunkedArray], rows: int) -> np.ndarray:
    """Where the runs of equal keys begin; null equals null."""
    new = np.zeros(rows, bool)
    new[:1] = True
    for column in columns:
        here, before = column.slice(1), column.slice(0, max(rows - 1, 0))
        changed = pc.fill_null(pc.not_equal(here, before), False)
        changed = pc.or_(changed, pc.xor(pc.is_null(here), pc.is_null(before)))
        new[1:] |= changed.to_numpy(zero_copy_only=False) if isinstance(changed, pa.Array) else changed.to_numpy()
    return np.flatnonzero(new)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[int]) -> Iterator[pa.Table]:
    """Tables that end where a run ends. A run that goes through many batches is held until it ends: one task's rows at most."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if held:  # does the run that is held go on?
            edge = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table.slice(0, 1)])
            if len(run_starts([edge.column(k) for k in keys], 2)) == 2:
                yield pa.concat_tables(held)
                held = []
        last = int(run_starts([table.column(k) for k in keys], table.num_rows)[-1])
        if last:
            yield pa.concat_tables([*held, table.slice(0, last)])
            held = []
        held.append(table.slice(last))
    if held:
        yield pa.concat_tables(held)


def in_pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PACKED_BYTES each: a batch has a number of rows, however long their cells."""
    rows = max(1, -(-batch.num_rows // (batch.nbytes // PACKED_BYTES + 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _packed(batch: pa.RecordBatch) -> list[bytes]:
    """The batch as small Parquet files of about PACKED_BYTES of rows each."""
    out = []
    for piece in in_pieces(batch):
        sink = pa.BufferOutputStream()
        pq.write_table(pa.Table.from_batches([piece]), sink, compression="zstd")
        out.append(sink.getvalue().to_pybytes())
    return out


def _unpacked(blob: pa.BinaryScalar) -> Iterator[pa.RecordBatch]:
    with pq.ParquetFile(pa.BufferReader(blob.as_buffer())) as file:
        yield from file.read(use_threads=False).combine_chunks().to_batches()


def _laid(part: int, end: int | None, packed: list[bytes]) -> pa.RecordBatch:
    """Rows of the table LAID."""
    columns = [pa.array([part] * len(packed), pa.int32()), pa.array([end] * len(packed), pa.int32()), pa.array(packed, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["_part", "_end", "_blob"])


def _marked(tables: Iterator[pa.Table]) -> Iterator[tuple[pa.Table, bool, bool]]:
    """The tables with whether each is the first and whether it is the last."""
    held, is_first = None, True
    for table in tables:
        if held is not None:
            yield held, is_first, False
            is_first = False
        held = table
    if held is not None:
        yield held, is_first, True


def _beside(ends: pa.StructArray, starts: np.ndarray, rows: int, is_first: bool, is_last: bool) -> pa.Array:
    """For each row: which of `ends` belongs to its run, or null."""
    at = np.full(rows, -1)
    for i, end in enumerate(ends.field("_end").to_pylist()):
        if is_first and end != LAST_RUN:
            at[: starts[1] if len(starts) > 1 else rows] = i
        if is_last and end != FIRST_RUN:
            at[starts[-1] :] = i
    return pa.array(at, mask=at < 0)


def _scanned(
    df: DataFrame, keys: list[str], order: list[str], notes: dict[str, str], note: Callable[[pa.Table], dict[str, pa.Array]],
    carried: dict[str, Column], added: dict[str, str], work: Callable[[pa.Table, np.ndarray], dict[str, pa.Array]], stored: bool = False, known_short: bool = False,
) -> DataFrame:
    """The rows with the columns `added`, computed run by run.

    notes: columns (name: type) that `note` tells of a run. carried: columns computed from them over the notes of one key's
    runs, in the order of tasks (window expressions). `work` gets whole runs of a task, those carried columns beside them
    (null where a run lies within one task), and their starts.
    """
    at = [df.columns.index(k) for k in keys]
    types, noted = dict(df.dtypes), list(notes)

    def layer(first_part: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        return lambda batches: lay(batches, first_part + TaskContext.get().partitionId())

    def lay(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        """The task's sorted rows as small Parquet files, and last what its first and its last run tell, one row each."""
        packed = []

        def passed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in in_pieces(batch):
                    packed.extend(_packed(piece))
                    yield piece

        first = last = None
        for table in whole_runs(passed(), at):
            yield _laid(part, None, packed)
            packed.clear()
            starts = run_starts([table.column(k) for k in at], table.num_rows)
            if first is None:
                first = table.slice(0, int(starts[1]) if len(starts) > 1 else None)
            last = table.slice(int(starts[-1]))
        if first is None:
            return
        yield _laid(part, None, packed)
        same = len(run_starts([pa.concat_tables([first.slice(0, 1), last.slice(0, 1)]).column(k) for k in at], 2)) == 1
        for end, run in ((BOTH_ENDS, first),) if same else ((FIRST_RUN, first), (LAST_RUN, last)):
            key = [c.chunk(0) for c in run.slice(0, 1).select(keys).combine_chunks().columns]
            told = note(run)
            values = [pa.array([part], pa.int32()), pa.array([end], pa.int32()), *key, *[told[name] for name in noted]]
            yield _laid(part, end, _packed(pa.RecordBatch.from_arrays(values, ["_part", "_end", *keys, *noted])))

    # A checkpoint keeps the tasks and the order of their rows. A key's rows are in one part.
    _shared_folder(df.sparkSession)
    checkpoints, tasks = [], 0
    for laid, short in runs_in_parts(df, keys, order, stored, known_short):
        with shuffles_removed(df.sparkSession), batches_by_rows(df.sparkSession, short):
            checkpoints.append(laid.mapInArrow(layer(tasks), LAID).checkpoint())
        tasks += checkpoints[-1].rdd.getNumPartitions()
    blobs = reduce(DataFrame.unionAll, checkpoints)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("_blob"):
                yield from _unpacked(blob)

    schema = ", ".join(f"`{c}` {t}" for c, t in [("_part", "int"), ("_end", "int"), *[(k, types[k]) for k in keys], *notes.items()])
    told = blobs.filter("_end is not null").select("_blob").mapInArrow(read, schema)
    carry = told.select("_part", F.struct("_end", *[c.alias(name) for name, c in carried.items()]).alias("_told"))
    # Two rows a task at most.
    carry = carry.groupBy(F.col("_part").alias("_of")).agg(F.collect_list("_told").alias("_ends"))
    beside = blobs.filter("_end is null").join(F.broadcast(carry), F.col("_part") == F.col("_of"), "left").select("_blob", "_ends")

    names = list(carried)
    dropped = [*names, *[c for c in added if c in df.columns]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = []

        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not ends:
                    ends.append(batch.column("_ends").slice(0, 1).flatten())
                for blob in batch.column("_blob"):
                    yield from _unpacked(blob)

        for table, is_first, is_last in _marked(whole_runs(rows(), at)):
            starts = run_starts([table.column(k) for k in at], table.num_rows)
            places = _beside(ends[0], starts, table.num_rows, is_first, is_last)
            given = table
            for name in names:
                given = given.append_column(name, ends[0].field(name).take(places))
            made = work(given, starts)
            out = given.drop_columns(dropped)
            for name, values in made.items():
                out = out.append_column(name, values)
            yield from out.select(out_columns).combine_chunks().to_batches()

    kept = [c for c in df.columns if c not in added]
    out_columns = [*kept, *added]
    schema = ", ".join(f"`{c}` {t}" for c, t in [*[(c, types[c]) for c in kept], *added.items()])
    return beside.mapInArrow(run, schema)


def _valid(column: pa.ChunkedArray) -> np.ndarray:
    return column.is_valid().to_numpy()


def _nearest(valid: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the last place in its run, up to it, that is valid (or -1), and the run's first valid place (or the number of rows)."""
    rows = len(valid)
    begin = np.repeat(starts, np.diff(np.append(starts, rows)))
    before = np.maximum.accumulate(np.where(valid, np.arange(rows), -1))
    first = np.minimum.reduceat(np.where(valid, np.arange(rows), rows), starts)
    return np.where(before >= begin, before, -1), np.repeat(first, np.diff(np.append(starts, rows)))


def crossfill(df: DataFrame, keys: list[str], columns: list[str], order: list[str], sizes: str | None = None, stored: bool = False, short: bool = False) -> DataFrame:
    """Fill nulls of `columns` from the other rows of the group: forward, then backward.
    `order` must be total. With `sizes`, a column of that name says how many rows the group has. `stored` rows are not written before (`runs_in_parts`)."""
    types = dict(df.dtypes)
    along = W.partitionBy(*keys).orderBy("_part")
    earlier, later = along.rowsBetween(W.unboundedPreceding, -1), along.rowsBetween(0, W.unboundedFollowing)
    notes = {f"_{end}_{c}": types[c] for c in columns for end in ("first", "last")}
    carried = {"_before_" + c: F.last("_last_" + c, True).over(earlier) for c in columns}
    carried |= {"_after_" + c: F.first("_first_" + c, True).over(later) for c in columns}
    added = {c: types[c] for c in columns}
    if sizes:
        notes["_rows"], carried["_total"], added[sizes] = "bigint", F.sum("_rows").over(W.partitionBy(*keys)), "bigint"

    def note(table: pa.Table) -> dict[str, pa.Array]:
        told = {"_rows": pa.array([table.num_rows], pa.int64())}
        for c in columns:
            there = np.flatnonzero(_valid(table.column(c)))
            for end, place in (("first", there[:1]), ("last", there[-1:])):
                found = pa.array(place if len(place) else [None], pa.int64())
                told[f"_{end}_{c}"] = table.column(c).combine_chunks().take(found)
        return told

    def fill(table: pa.Table, starts: np.ndarray) -> dict[str, pa.Array]:
        out, run = {}, np.diff(np.append(starts, table.num_rows))
        if sizes:
            out[sizes] = pc.coalesce(table.column("_total").combine_chunks(), pa.array(np.repeat(run, run), pa.int64()))
        for c in columns:
            values = table.column(c).combine_chunks()
            before, first = _nearest(_valid(table.column(c)), starts)
            up_to = values.take(pa.array(before, mask=before < 0))
            after = values.take(pa.array(first, mask=first >= len(first)))
            out[c] = pc.coalesce(up_to, table.column("_before_" + c).combine_chunks(), table.column("_after_" + c).combine_chunks(), after)
        return out

    filled = _scanned(df, keys, order, notes, note, carried, added, fill, stored, short)
    return filled.select(*df.columns, *([sizes] if sizes else []))


def number_in_group(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Running number (from 1) within the group. `order` must be total."""
    along = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)

    def number(table: pa.Table, starts: np.ndarray) -> dict[str, pa.Array]:
        begin = np.repeat(starts, np.diff(np.append(starts, table.num_rows)))
        before = table.column("_before").fill_null(0).to_numpy()
        return {name: pa.array(np.arange(table.num_rows) - begin + 1 + before, pa.int64())}

    return _scanned(
        df, keys, order, {"_rows": "bigint"}, lambda table: {"_rows": pa.array([table.num_rows], pa.int64())},
        {"_before": F.sum("_rows").over(along)}, {name: "bigint"}, number,
    )
