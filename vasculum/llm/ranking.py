"""Ranked lexical search by buckets of vector length.

A document is a vector of impacts, an item one of weighted term counts, and a score is their product. Documents are ordered by
the length of their vectors and searched from the longest down. With the score that an item's last place has so far,
the inequality of Cauchy and Schwarz rules out whole buckets, down to the point where all that is left is too short; inside a bucket the
item's greatest coordinates are added up, the rest is bounded by the rest of both lengths, and what survives is scored in integers.

Items are searched in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vasculum.llm.storage import in_parts, stored

#: Bytes of text that a task takes apart at once.
PART_BYTES = 2_000_000
#: Characters of the items of a block, on average; a block's terms and items are broadcast.
ITEM_CHARS = 4_000_000
#: Documents of a bucket of vector lengths, and the fewest and most buckets. A bucket lies in files of FILE_ROWS documents or more, so that
#: its search is spread over tasks too; there are some MOST_FILES files at most.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 50_000, 16, 20_000
FILE_ROWS, MOST_FILES = 1_000, 100_000
#: Documents that are bounded together inside a bucket: at first, and at most.
FIRST_SLICE, LAST_SLICE = 256, 4_096
#: The coordinates of an item that are added up before the rest is bounded hold this share of its squared length.
FOCUS = 0.6
#: Separators become spaces, capital letters small ones; digits, letters and all bytes beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def count_terms(text: bytes) -> tuple[int, Counter]:
    """Number of terms of a text in UTF-8, and how often each occurs. Long texts are taken apart at separators."""
    counts: Counter = Counter()
    n = at = 0
    while at < len(text):
        cut = _SEPARATOR.search(text, at + PART_BYTES) if len(text) - at > PART_BYTES else None
        end = cut.start() if cut else len(text)
        terms = text[at:end].translate(_TABLE).split()
        counts.update(terms)
        n += len(terms)
        at = end
    return n, counts


class Items:
    """A block of items: their terms, weights and lengths."""

    def __init__(self, texts: list[str | None]):
        counted = [count_terms((t or "").encode())[1] for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
        self.terms = [np.array([self.vocabulary[t] for t in c], np.int64) for c in counted]
        self.times = [np.array(list(c.values()), np.int64) for c in counted]

    def weigh(self, documents: int, frequency: dict[int, int]) -> None:
        """Set the coordinates of all items, greatest first, and how many of them are the focus."""
        weight = np.zeros(len(self.vocabulary), np.int64)
        for term, df in frequency.items():
            weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        self.coordinates, self.focus, self.rest = [], [], []
        for terms, times in zip(self.terms, self.times, strict=True):
            values = times * weight[terms]
            order = np.argsort(-values, kind="stable")
            order = order[values[order] > 0]
            self.coordinates.append((terms[order], values[order]))
            squares = values[order].astype(float) ** 2
            upto = np.cumsum(squares)
            focus = int(np.searchsorted(upto, FOCUS * upto[-1])) + 1 if len(order) else 0
            self.focus.append(focus)
            self.rest.append(math.sqrt(float(squares[focus:].sum())))
        self.lengths = np.array([math.sqrt(float((v.astype(float) ** 2).sum())) for _, v in self.coordinates])


def _vectors(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, n, terms, times) of the documents with a term: n counts all of them, the lists hold those of the items."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)  # terms of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for rows in in_parts(batch, 1, PART_BYTES):
                ids, sizes, terms, times = [], [], [], []
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                    n, counts = count_terms(text.as_py())
                    if n:
                        own = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                        ids.append(doc)
                        sizes.append(n)
                        terms.append([t for t, _ in own])
                        times.append([k for _, k in own])
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                arrays = [pa.array(x, k) for x, k in zip((ids, sizes, terms, times), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "times"])

    return source.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def _impacts(n: np.ndarray, doc: np.ndarray, times: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Impact of each entry; `doc` is the place in `n` of the entry's document."""
    m = 75 + 25 * n * documents // words
    return 1_000_000_000 * times // (1000 * times + 12 * m[doc])


def _entries(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n, first entry of each document and the end, terms, times) of a batch."""
    terms, times = rows.column(rows.schema.get_field_index("terms")), rows.column(rows.schema.get_field_index("times"))
    sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
    n = rows.column(rows.schema.get_field_index("n")).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return n, bounds, terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _with_length(vectors: DataFrame, documents: int, words: int) -> DataFrame:
    """The rows with the length of their impact vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bounds, _, times = _entries(batch)
            doc = np.repeat(np.arange(len(n)), np.diff(bounds))
            impacts = _impacts(n, doc, times, documents, words).astype(float)
            length = np.sqrt(np.bincount(doc, impacts * impacts, len(n)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length)], [*batch.schema.names, "length"])

    return vectors.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>, length double")


class _Best:
    """The best documents of each item so far, equal scores by ascending id, null ids last."""

    def __init__(self, least: np.ndarray, top: int):
        self.least, self.top = least.copy(), top
        self.rows: list[np.ndarray] = [np.zeros((0, 3), np.int64) for _ in least]  # (-score, id is null, id)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        rows = np.concatenate([self.rows[item], np.stack([-scores, unknown, ids], axis=1)])
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))[: self.top]]
        self.rows[item] = rows
        if len(rows) == self.top:
            self.least[item] = max(self.least[item], -rows[-1, 0])


def _search_slice(rows: pa.RecordBatch, items: Items, best: _Best, documents: int, words: int) -> None:
    """Add the documents of a slice that may be among the best of an item."""
    n, bounds, terms, times = _entries(rows)
    ids = rows.column(0)
    unknown = np.asarray(ids.is_null().to_numpy(zero_copy_only=False)).astype(np.int64)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(n)), np.diff(bounds))
    impacts = _impacts(n, doc, times, documents, words)
    squares = np.bincount(doc, impacts.astype(float) ** 2, len(n))
    longest = math.sqrt(float(squares.max(initial=0)))
    by_term = np.argsort(terms, kind="stable")
    columns = np.searchsorted(terms[by_term], np.arange(len(items.vocabulary) + 1))
    weights = np.zeros(len(items.vocabulary), np.int64)
    for item in np.flatnonzero((items.lengths * longest * (1 + 1e-9) + 1 >= best.least) & (items.lengths > 0)).tolist():
        own, values = items.coordinates[item]
        part, left = np.zeros(len(n)), squares.copy()
        for term, value in zip(own[: items.focus[item]].tolist(), values[: items.focus[item]].tolist(), strict=True):
            at = by_term[columns[term] : columns[term + 1]]  # a document holds a term once
            part[doc[at]] += value * impacts[at]
            left[doc[at]] -= impacts[at].astype(float) ** 2
        # Rounding moves a bound by far less than a part in 10^9 of the product of both lengths.
        bound = part + items.rest[item] * np.sqrt(np.maximum(left, 0)) + 1e-9 * items.lengths[item] * longest + 1
        some = np.flatnonzero((bound >= best.least[item]) & ((part > 0) | (items.rest[item] > 0)))
        if not len(some):
            continue
        weights[own] = values
        sizes = bounds[some + 1] - bounds[some]
        at = np.repeat(bounds[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        scores = np.zeros(len(some), np.int64)
        products = weights[terms[at]] * impacts[at]
        filled = np.flatnonzero(sizes)
        if len(filled):
            scores[filled] = np.add.reduceat(products, (np.cumsum(sizes) - sizes)[filled])
        weights[own] = 0
        hit = np.flatnonzero((scores > 0) & (scores >= best.least[item]))
        if len(hit):
            best.add(item, scores[hit], ids[some[hit]], unknown[some[hit]])


def _search(bucket: DataFrame, items: Items, least: np.ndarray, top: int, documents: int, words: int) -> DataFrame:
    """Rows (item, score, doc_id): at least those documents of the bucket that are among its best `top` of an item and reach its least score."""
    shared = bucket.sparkSession.sparkContext.broadcast((items, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, start = shared.value
        best, size = _Best(start, top), FIRST_SLICE
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                _search_slice(batch.slice(at, size), block, best, documents, words)
                at, size = at + size, min(2 * size, LAST_SLICE)
        for item, rows in enumerate(best.rows):
            if len(rows):
                ids = pa.array(rows[:, 2], pa.int64(), mask=rows[:, 1] == 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), item), pa.int64()), pa.array(-rows[:, 0]), ids], ["item", "score", "doc_id"])

    return bucket.mapInArrow(run, "item long, score long, doc_id long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _rank_block(docs: DataFrame, items: Items, top: int, id_col: str, text_col: str) -> DataFrame | None:
    vectors = stored(_vectors(docs, items, id_col, text_col), "vectors")
    documents, words = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    terms = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # terms of one block of items
    items.weigh(documents, {r["term"]: r["count"] for r in terms})

    wanted = min(max(LEAST_BUCKETS, -(-documents // BUCKET_ROWS)), MOST_BUCKETS)
    lengths = _with_length(vectors.filter(F.size("terms") > 0), documents, words)
    # Equal lengths are dealt by a hash, so that copies do not fill one bucket.
    buckets = lengths.withColumn("deal", F.xxhash64("doc_id", "n")).repartitionByRange(wanted, F.desc("length"), "deal")
    buckets = buckets.sortWithinPartitions(F.desc("length")).withColumn("bucket", F.spark_partition_id())
    buckets = stored(buckets.drop("deal"), "buckets", max(FILE_ROWS, documents // MOST_FILES))
    longest = {r["bucket"]: r["longest"] for r in buckets.groupBy("bucket").agg(F.max("length").alias("longest")).collect()}  # one row a bucket
    best, least = None, np.zeros(len(items.lengths), np.int64)
    first, count = 0, 1
    while any(b >= first for b in longest):
        reach = max(x for b, x in longest.items() if b >= first)
        if (items.lengths * reach * (1 + 1e-9) + 1 < least).all():
            break  # what is left is too short for every item
        wave = buckets.filter((F.col("bucket") >= first) & (F.col("bucket") < first + count)).drop("bucket", "length")
        found = _search(wave, items, least, top, documents, words)
        best = stored(_ranked(found if best is None else found.unionByName(best.drop("rank")), top), "best")
        for r in best.filter(F.col("rank") == top).select("item", "score").collect():  # one row an item of the block
            least[r["item"]] = r["score"]
        first, count = first + count, 4 * count
    return best


def rank(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the `top` documents of the highest score above 0 for each item.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case; whole texts are read, null has none. Scores
    are exact integers, equal ones go by ascending doc_id, null ids last. Every row of `items` is an item, every row of
    `docs` a document, repeated ones too; an item without terms, or whose terms no document holds, has no rows. Other columns are ignored.
    Empty tables give no rows. The driver holds one block of items (about ITEM_CHARS characters, one item at least), its terms, one number a
    bucket and one least score an item.
    """
    spark = docs.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(query_col).alias("text")).filter("text is not null")
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // ITEM_CHARS)
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        best = _rank_block(docs, Items([r["text"] for r in own]), top, id_col, text_col) if own else None
        if best is not None:
            names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], "item long, item_id long")
            named = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")  # items of one block
            out = out.unionByName(named)
    return out


#: DuckDB: the same scores of all documents.
SQL = r"""
with words as (
  select rowid as row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as rowid, * from documents)
), totals as (
  select count(distinct row)::bigint as docs, count(*)::bigint as total from words
), sizes as (
  select row, any_value(doc_id) as doc_id, count(*)::bigint as n from words group by row
), entries as (
  select row, term, count(*)::bigint as tf from words group by row, term
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from entries, totals group by term, docs
), wanted as (
  select item, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as item, * from benchmark)
), scores as (
  select q.item, any_value(q.item_id) as item_id, e.row, any_value(s.doc_id) as doc_id,
    sum(w.w * ((1000000000 * e.tf) // (1000 * e.tf + 12 * (75 + (25 * s.n * docs) // total))))::bigint as score
  from wanted q join entries e using (term) join weights w using (term) join sizes s on s.row = e.row, totals
  group by q.item, e.row
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scores where score > 0)
where rank <= 20
"""
