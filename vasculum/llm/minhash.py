"""Near duplicates by MinHash: universal hash minima, banding, signature and exact verification, components.

Documents with equal shingle sets form one class, found by a 128-bit fingerprint, and only classes go on.
First every class is paired with that smallest class of its bands' buckets whose signature agrees best; full sets confirm,
and alternating stars give components. Then the classes of a bucket that are still apart are compared with each other,
inside the bucket and in blocks of bounded size. As long as that joins many, each class tells only its best pair, and classes
without one leave; at last all pairs that are still apart are compared by their sets' prints, so nothing is lost to the choice
of the smallest or the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vasculum.llm.components import connected_components
from vasculum.llm.storage import in_parts, picked, stored

#: 25 bands of 5 rows: a pair of similarity 0.8 is missed with probability 5e-5.
BANDS, ROWS = 25, 5
#: Minima of a signature, of which the first make the bands. Pairs whose signatures agree in less than the threshold less
#: SLACK are dropped (five standard deviations). Signatures hold 16 bits of each minimum.
MINIMA, SLACK = 250, 0.127
#: Classes of one bucket compared in one block, and links verified against one text in one group.
BLOCK, VERIFY = 1_500, 100
#: Shingles up to which a set has prints, 4 bytes each; pairs of larger sets are verified on signatures alone.
PRINTS = 20_000
PART_CHARS = 1_000_000
_RANDOM = np.random.RandomState(20_011)
_A = (_RANDOM.randint(0, 2**62, MINIMA, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RANDOM.randint(0, 2**62, MINIMA, dtype=np.int64).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text; a shorter text is one shingle, one without words none."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(hashes))
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for k in range(width):
        out = (out ^ hashes[k : k + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes (a x + b, upper half) over a set that is not empty."""
    out = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 256):  # a block of hashes stays in the processor's cache
        block = _A[:, None] * found[at : at + 256]
        block += _B[:, None]
        np.minimum(out, block.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """Keys of the bands, a row for each signature of 16-bit minima."""
    parts = minima[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(parts), 1))
    for k in range(ROWS):
        keys = (keys ^ parts[:, :, k]) * _MIX
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, f1, f2, minima); fingerprint and minima are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            for rows in in_parts(batch, 1, PART_CHARS):
                out: list[list] = [[] for _ in range(4)]
                for text in rows.column(1).to_pylist():
                    found = shingles(text, words)
                    row = [len(found), None, None, None]
                    if len(found):
                        print128 = xxh3_128_intdigest(found.tobytes())
                        minima = signature(found)
                        two = np.array([print128 >> 64, print128 & (2**64 - 1)], np.uint64).astype(np.int64)
                        row = [len(found), int(two[0]), int(two[1]), minima.astype(np.uint16).tobytes()]
                    for values, x in zip(out, row, strict=True):
                        values.append(x)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))],
                    ["doc_id", "n_shingles", "f1", "f2", "minima"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, minima binary")


def _matrix(minima: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(minima), np.uint16).reshape(len(minima), MINIMA)


def _banded(classes: DataFrame) -> DataFrame:
    """Rows (node, key), one for each band of a class; a key holds its band's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _band_keys(_matrix(batch.column(1).to_pylist()))
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
            keys = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), keys], ["node", "keys"])

    return classes.select("node", "minima").mapInArrow(run, "node long, keys array<long>").select("node", F.explode("keys").alias("key"))


def _by_signature(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) whose sizes and signatures allow the threshold, that of each b whose signatures agree best."""
    one = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("minima").alias("ma"))
    two = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("minima").alias("mb"))
    sized = pairs.join(one, "a").join(two, "b")
    sized = sized.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b", "ma", "mb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = (_matrix(batch.column(2).to_pylist()) == _matrix(batch.column(3).to_pylist())).mean(axis=1)
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], ["a", "b", "share"])
            yield rows.filter(pa.array(share >= percent / 100 - SLACK))

    found = sized.mapInArrow(run, "a long, b long, share double")
    return found.groupBy("b").agg(F.max(F.struct("share", "a")).alias("best")).select("best.a", "b")


def _prints(texts: DataFrame, words: int) -> DataFrame:
    """Rows (node, prints): the sorted upper halves of all shingle hashes of a text, empty beyond PRINTS shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in in_parts(batch, 1, PART_CHARS):
                sets = (shingles(text, words) for text in rows.column(1).to_pylist())
                halves = [(x >> np.uint64(32)).astype(np.uint32).tobytes() if len(x) <= PRINTS else b"" for x in sets]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(halves, pa.binary())], ["node", "prints"])

    return texts.select("id", "text").mapInArrow(run, "node long, prints binary")


def _may_share(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """If two sets can meet the threshold: prints in common are never fewer than common shingles."""
    if not len(a) or not len(b):
        return True
    common = int((b[np.minimum(b.searchsorted(a), len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold. A text that many pairs share goes to several groups, each with some of them."""
    counts = pairs.groupBy("a").count()
    pairs = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / VERIFY))).drop("count")
    sides = pairs.select("a", "salt", F.lit(0).alias("side"), F.col("a").alias("id")).distinct().unionByName(
        pairs.select("a", "salt", F.lit(1).alias("side"), F.col("b").alias("id"))
    )
    rows = sides.join(texts, "id").repartition("a", "salt").sortWithinPartitions("a", "salt", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads = None, []
        for batch in batches:
            links = []
            for a, salt, side, other, text in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "side", "id", "text")), strict=True):
                if (a, salt) != key:
                    key, heads = (a, salt), []
                found = shingles(text, words)
                if side == 0:
                    heads.append(found)
                    continue
                for head in heads:
                    common = len(np.intersect1d(head, found, assume_unique=True))
                    if 100 * common >= percent * (len(head) + len(found) - common) > 0:
                        links.append((a, other))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _apart(buckets: DataFrame, components: DataFrame, classes: DataFrame, percent: int, prints: DataFrame | None = None) -> DataFrame:
    """Pairs of one bucket that lie in different components and whose sizes and signatures allow the threshold.

    With `prints`, all pairs whose prints allow it too; without, of each class only the pair whose signatures agree best.
    """
    best_only = prints is None
    placed = buckets.select("key", "node").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).filter("x <> y")
    members = placed.join(mixed.select("key", "n"), "key").join(classes, "node")
    if not best_only:
        members = members.join(prints, "node")
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("node"), blocks)
    members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = members.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    columns = ["key", "i", "j", "node", "component", "n_shingles", "own"]

    def compare(across: bool, node, comp, size, own, minima) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of one bucket's blocks and the shares in which they agree; rows come by node."""
        one, two, shares = [], [], []
        best, partner = np.zeros(len(node)), np.full(len(node), -1)
        for k in range(len(node) - 1):
            rest = slice(k + 1, None)
            fits = (node[rest] > node[k]) & (comp[rest] != comp[k])
            fits &= 100 * np.minimum(size[rest], size[k]) >= percent * np.maximum(size[rest], size[k])
            if across:
                fits &= own[rest] != own[k]
            at = k + 1 + np.flatnonzero(fits)
            share = (minima[at] == minima[k]).mean(axis=1)
            good = share >= percent / 100 - SLACK
            at, share = at[good], share[good]
            if not len(at):
                continue
            if best_only:
                more = share > best[at]
                best[at[more]], partner[at[more]] = share[more], k
                if share.max() > best[k]:
                    best[k], partner[k] = share.max(), at[share.argmax()]
            else:
                one.append(np.full(len(at), k))
                two.append(at)
                shares.append(share)
        if best_only:
            at = np.flatnonzero(partner >= 0)
            return at, partner[at], best[at]
        return (np.concatenate(one), np.concatenate(two), np.concatenate(shares)) if one else (partner[:0], partner[:0], best[:0])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The sorted rows again, cut only where a new pair of blocks begins."""
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            last = np.ones(rows.num_rows, bool)
            for c in ("key", "i", "j"):
                values = rows.column(c).to_numpy()
                last &= values == values[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield rows.slice(0, cut)
            rest = rows.slice(cut)
        if rest is not None:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole(batches):
            key, i, j, node, comp, size, own = (rows.column(c).to_numpy() for c in columns)
            minima = _matrix(rows.column("minima").to_pylist())
            new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            ends = [0, *(np.flatnonzero(new) + 1).tolist(), len(key)]
            for a, b in zip(ends, ends[1:], strict=False):
                at = slice(a, b)
                one, two, share = compare(i[a] != j[a], node[at], comp[at], size[at], own[at], minima[at])
                if len(one) and not best_only:
                    # A pair that shares several buckets is told in that of the first band only.
                    used, where = np.unique(np.concatenate([one, two]), return_inverse=True)
                    bands = _band_keys(minima[at][used])
                    mine, its = bands[where[: len(one)]], bands[where[len(one) :]]
                    first = (mine == its).argmax(axis=1)
                    here = mine[np.arange(len(one)), first] == key[a]
                    one, two, share = one[here], two[here], share[here]
                    sets = [np.frombuffer(x.as_py(), np.uint32) for x in rows.column("prints").slice(a, b - a)]
                    here = np.array([_may_share(sets[x], sets[y], percent) for x, y in zip(one, two, strict=True)], bool)
                    one, two, share = one[here], two[here], share[here]
                if len(one):
                    yield pa.RecordBatch.from_arrays([pa.array(node[a + one]), pa.array(node[a + two]), pa.array(share)], ["a", "b", "share"])

    rows = members.select(*columns, "minima", *([] if best_only else ["prints"])).repartition("key", "i", "j")
    told = rows.sortWithinPartitions("key", "i", "j", "node").mapInArrow(run, "a long, b long, share double")
    if best_only:
        told = told.groupBy("a").agg(F.max(F.struct("share", "b")).alias("best")).select("a", "best.b")
    return told.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each document.

    Documents are linked if 100 * intersection >= percent * union of their sets of distinct `words`-word shingles (A-Z lower-cased, words
    parted by ASCII white space). component_id is the smallest doc_id reachable, kept says that it is the document's own. A null, empty or
    blank text has no shingles and no link. Repeated rows are copies of one document and come back as often. Rows without id get a null
    component if nothing with an id equals them, and are never kept. Other columns are ignored; no rows give no rows.
    """
    signed = stored(signatures(docs, words, id_col, text_col), "signatures")
    full = signed.filter("n_shingles > 0")
    classes = full.filter("doc_id is not null").groupBy("f1", "f2").agg(
        F.min("doc_id").alias("node"), F.min_by(F.struct("n_shingles", "minima"), "doc_id").alias("own")
    )
    classes = stored(classes.select("f1", "f2", "node", "own.n_shingles", "own.minima"), "classes")
    banded = _banded(classes)
    least = banded.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    buckets = stored(banded.join(least.select("key", "a"), "key"), "buckets")
    # Only classes that meet another are ever compared or verified: their signatures and texts are picked once.
    meeting = stored(buckets.select("node").distinct(), "meeting")
    met = stored(picked(classes.select("node", "n_shingles", "minima"), "node", meeting), "met")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stored(picked(texts, "id", meeting.select(F.col("node").alias("id"))), "texts")
    pairs = buckets.filter("a <> node").select("a", F.col("node").alias("b")).distinct()
    links = stored(_verify(_by_signature(pairs, met, percent), texts, words, percent).distinct(), "links")
    components = stored(connected_components(links), "components")
    prints, last = None, False
    while True:
        more = stored(_apart(buckets, components, met, percent, prints), "apart")
        told = more.count()
        if told:
            found = stored(_verify(more, texts, words, percent).distinct(), "links")
            joined = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
            components = stored(connected_components(joined.unionByName(found)), "components")
        if last or not told:
            break
        # A class that has told nothing and been told by none has no pair left; components only grow.
        left = stored(more.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "left")
        buckets = stored(picked(buckets, "node", left), "buckets")
        last = found.count() * 10 < told
        if last:
            prints = stored(_prints(picked(texts, "id", left.select(F.col("node").alias("id"))), words), "prints")
    placed = classes.select("f1", "f2", "node").join(components, "node", "left")
    placed = placed.select("f1", "f2", F.coalesce("component", "node").alias("component_id"))
    result = full.select("doc_id", "n_shingles", "f1", "f2").join(placed, ["f1", "f2"], "left").select("doc_id", "n_shingles", "component_id")
    empty = signed.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.unionByName(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one left of each group of near duplicates, that of the smallest id; columns unchanged.

    Repeated rows of one id count as copies, so one of them stays. Rows without id stay.
    """
    found = near_duplicates(docs, words, percent, id_col, text_col)
    drop = found.filter(F.col("doc_id").isNotNull() & ~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    repeated = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(id_col))
    rest = picked(docs, id_col, stored(drop, "dropped"), "left_anti")
    repeated = stored(repeated, "repeated")
    if repeated.isEmpty():
        return rest.select(docs.columns)
    once = rest.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return rest.join(repeated, id_col, "left_anti").unionByName(once).select(docs.columns)


#: The result of `near_duplicates` for words of two and 80 per cent, by an exact join of equal shingles; equal texts are one class throughout.
SQL = r"""WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
  ELSE list_sort(list_distinct(list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1]))) END AS s FROM split),
classes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY s),
entries AS (SELECT node, n, unnest(s) AS shingle FROM classes),
links AS (SELECT a.node AS x, b.node AS y FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.node < b.node AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT node, node AS seen FROM classes UNION SELECT r.node, b.y FROM reach r JOIN edges b ON b.x = r.seen),
least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id, d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM shingled d LEFT JOIN classes c ON d.s = c.s LEFT JOIN least l ON l.node = c.node"""
