"""Near duplicates of embeddings by lattice hashing.

Vectors are scaled to length one, projected at random to pairs of eight dimensions in several tables, and decoded to the nearest points
of the lattice E8. A pair of points is a cell; a vector is entered in its own cell and asked for in neighbouring ones. Vectors
that meet in a cell are compared in double precision. Cells of few vectors are compared pair by pair, many cells at a time; cells of
many in blocks, and a block returns link counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vasculum.llm.components import connected_components
from vasculum.llm.storage import stored

#: Tables, lattice scale for vectors of 64 dimensions, and neighbours asked for each of the two points: at cosine 0.95 a pair is found
#: with probability 0.99 (measured on 3,000 pairs of 8 to 768 dimensions each).
TABLES, SCALE, NEIGHBOURS = 6, 0.24, 4
#: Vectors of a cell compared in one block, and up to how many they are compared pair by pair.
BLOCK, FEW = 1_000, 32
SEED = 8_191


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """Nearest points of E8: the nearer one of D8 and D8 + 1/2."""

    def nearest_d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        odd = np.flatnonzero(near.sum(axis=1) % 2)
        off = (y - near)[odd]
        k = np.abs(off).argmax(axis=1)
        near[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1, -1)
        return near

    whole, half = nearest_d8(points), nearest_d8(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@cache
def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    signs = np.array(np.meshgrid(*[[1, -1]] * 8)).reshape(8, -1).T
    halves = signs[signs.prod(axis=1) == 1] / 2
    wholes = [a * np.eye(8)[i] + b * np.eye(8)[j] for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    return np.concatenate([halves, np.array(wholes)])


@cache
def _projection(size: int, table: int) -> np.ndarray:
    """Orthonormal columns, 16 of them, for vectors of a size; shorter vectors are padded with zeros."""
    width = max(size, 16)
    return np.linalg.qr(np.random.RandomState(SEED + table).standard_normal((width, 16)))[0][:size]


def _keys(table: int, size: int, *points: np.ndarray) -> np.ndarray:
    """Hashes of cells, unlike for every table and vector size."""
    out = np.full(points[0].shape[:-1], (table + 1) * 0x9E3779B1 + size, np.uint64)
    for value in np.moveaxis(np.rint(2 * np.concatenate(points, axis=-1)).astype(np.int64).astype(np.uint64), -1, 0):
        out = (out ^ value) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out.astype(np.int64)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _scale(size: int) -> float:
    """Lattice scale for vectors of a size: 16 of its dimensions hold that share of a distance's square; shorter vectors are kept whole."""
    return SCALE * (64 / max(size, 16)) ** 0.5


def cells(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own cell in each table, and the neighbouring cells in each: (n, tables) and (n, tables, 2 x neighbours)."""
    own, near = [], []
    for table in range(TABLES):
        shown = unit(vectors) @ _projection(vectors.shape[1], table) / _scale(vectors.shape[1])
        halves = [shown[:, :8], shown[:, 8:]]
        points = [nearest_e8(h) for h in halves]
        beside = []
        for h, p in zip(halves, points, strict=True):
            towards = np.argpartition(-((h - p) @ _roots().T), NEIGHBOURS - 1, axis=1)[:, :NEIGHBOURS]
            beside.append(p[:, None, :] + _roots()[towards])
        rest = [np.repeat(p[:, None, :], NEIGHBOURS, axis=1) for p in points]
        own.append(_keys(table, vectors.shape[1], *points))
        near.append(np.concatenate([_keys(table, vectors.shape[1], beside[0], rest[1]), _keys(table, vectors.shape[1], rest[0], beside[1])], axis=1))
    return np.stack(own, axis=1), np.stack(near, axis=1)


def _coded(classes: DataFrame) -> DataFrame:
    """Classes (node, weight, vector) with their cells: own, one a table, and near, the tables' neighbours one after another; as numbers to
    be entered one by one, and as bytes, as is the vector, to be sent along whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                rows = batch.slice(at, 1_000)
                vectors = [np.array(v, dtype=np.float64) for v in rows.column(2).to_pylist()]
                own: list = [None] * len(vectors)
                near: list = [None] * len(vectors)
                for size in {len(v) for v in vectors}:
                    index = [i for i, v in enumerate(vectors) if len(v) == size]
                    first, second = cells(np.stack([vectors[i] for i in index]))
                    for k, i in enumerate(index):
                        own[i], near[i] = first[k], second[k].ravel()
                numbers = [pa.array(keys, pa.list_(pa.int64())) for keys in (own, near)]
                packed = [pa.array([np.ascontiguousarray(x).tobytes() for x in column], pa.binary()) for column in (vectors, own, near)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], *numbers, *packed], [*rows.schema.names[:2], "own", "near", "vector", "own_bytes", "near_bytes"])

    kinds = "node long, weight long, own array<long>, near array<long>, vector binary, own_bytes binary, near_bytes binary"
    return classes.mapInArrow(run, kinds)


def _met(own_a: np.ndarray, near_a: np.ndarray, own_b: np.ndarray, near_b: np.ndarray) -> np.ndarray:
    return (own_a == own_b) | (near_a == own_b[:, None]).any(axis=1) | (near_b == own_a[:, None]).any(axis=1)


class _Meetings:
    """Vectors of one size that meet in blocks of cells, sorted by block: (table, cell, i, j)."""

    def __init__(self, rows: pa.Table, threshold: float):
        self.threshold = threshold
        self.table, self.cell, self.i, self.j, self.node, self.home, self.chunk, self.weight = (
            rows[c].to_numpy() for c in ("table", "cell", "i", "j", "node", "home", "chunk", "weight")
        )

        def flat(column: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(rows[column].to_pylist()), kind).reshape(len(self.node), -1)

        self.vectors = unit(flat("vector", np.float64))
        self.own = flat("own", np.int64)
        self.near = flat("near", np.int64).reshape(len(self.node), TABLES, -1)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First rows of the blocks, and rows after the last ones."""
        key = np.stack([self.table, self.cell, self.i, self.j])
        first = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        return first, np.append(first[1:], len(self.node))

    def _counted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """If a linked pair is counted here: in the first table in which the two meet, and if each asks there for the other's cell, in the lesser."""
        table, cell = self.table[x], self.cell[x]
        at = np.arange(len(x))
        swap = ~self.home[x]
        x, y = np.where(swap, y, x), np.where(swap, x, y)  # x is at home
        before = ~self.home[y] & (self.near[x, table] == self.own[y, table][:, None]).any(axis=1) & (self.own[y, table] < cell)
        for t in range(TABLES - 1):
            later = at[~before & (table > t)]
            u, v = x[later], y[later]
            before[later] = _met(self.own[u, t], self.near[u, t], self.own[v, t], self.near[v, t])
        return ~before

    def few(self, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of small blocks: rows (node, linked weight, least node of the pair), two a linked pair."""
        sizes = last - first
        for size in np.unique(sizes):
            a, b = np.triu_indices(size, 1)
            starts = first[sizes == size]
            step = max(1, 100_000 // max(len(a), 1))
            for at in range(0, len(starts) if size > 1 else 0, step):
                x, y = ((starts[at : at + step, None] + k).ravel() for k in (a, b))
                keep = (self.home[x] | self.home[y]) & (self.node[x] != self.node[y])
                keep &= (self.i[x] == self.j[x]) | (self.chunk[x] != self.chunk[y])
                x, y = x[keep], y[keep]
                for part in range(0, len(x), 20_000):
                    u, v = x[part : part + 20_000], y[part : part + 20_000]
                    linked = np.einsum("ij,ij->i", self.vectors[u], self.vectors[v]) >= self.threshold
                    u, v = u[linked], v[linked]
                    counted = self._counted(u, v)
                    u, v = u[counted], v[counted]
                    low = np.minimum(self.node[u], self.node[v])
                    yield np.concatenate([self.node[u], self.node[v]]), np.concatenate([self.weight[v], self.weight[u]]), np.concatenate([low, low])

    def many(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one block: linked weight of each vector, and the least node of its component in the block."""
        rows = np.arange(first, last)
        rows = rows[np.argsort(self.node[rows], kind="stable")]
        node, weight, home, chunk = self.node[rows], self.weight[rows], self.home[rows], self.chunk[rows]
        vectors = self.vectors[rows]
        entered, everyone = np.flatnonzero(home), np.arange(len(rows))
        linked = np.zeros((len(rows), len(rows)), bool)
        counts = np.zeros(len(rows), np.int64)
        linked[entered] = vectors[entered] @ vectors.T >= self.threshold
        linked[everyone, everyone] = False
        if self.i[first] != self.j[first]:
            linked &= chunk[:, None] != chunk
        a, b = np.nonzero(linked)
        once = ~home[b] | (a < b)  # two that are both at home here meet twice in the matrix
        a, b = a[once], b[once]
        for at in range(0, len(a), 200_000):
            x, y = a[at : at + 200_000], b[at : at + 200_000]
            counted = self._counted(rows[x], rows[y])
            x, y = x[counted], y[counted]
            counts += np.bincount(x, weight[y], len(rows)).astype(np.int64) + np.bincount(y, weight[x], len(rows)).astype(np.int64)
        linked |= linked.T
        head = np.full(len(rows), -1)
        for k in everyone:
            if head[k] < 0:
                reach = np.zeros(len(rows), bool)
                reach[k], front = True, np.array([k])
                while len(front):
                    found = linked[front].any(axis=0) & ~reach
                    reach |= found
                    front = np.flatnonzero(found)
                head[reach] = k
        keep = (counts > 0) | (head != everyone)
        return node[keep], counts[keep], node[head[keep]]


def _compare(threshold: float):
    """Function for mapInArrow over members sorted by block: rows (node, links, head) as of `_Meetings`."""

    def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.binary_length(rows["vector"])
        for size in pc.unique(sizes).to_pylist():
            met = _Meetings(rows.filter(pc.equal(sizes, size)), threshold)
            first, last = met.runs()
            small = last - first <= FEW
            found = [*met.few(first[small], last[small]), *(met.many(a, b) for a, b in zip(first[~small], last[~small], strict=True))]
            for node, links, head in found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, links, head)], ["node", "links", "head"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last block so far, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)])
            new = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            begin = int(new[-1]) + 1 if len(new) else 0
            same = not held or all(held[-1].column(c)[-1].as_py() == int(key[c, 0]) for c in range(4))
            if begin == 0 and same:
                held.append(batch)
                continue
            yield from compared(pa.Table.from_batches([*held, batch.slice(0, begin)], batch.schema))
            held = [batch.slice(begin)]
        if held:
            yield from compared(pa.Table.from_batches(held))

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each vector.

    Pairs found whose cosine in double precision is at least `threshold` are linked. Equal vectors form one class and are counted by its size, so
    copies are never paired one by one. Null, zero and empty vectors and those with null, NaN or infinite components
    link with nothing. Vectors of different sizes do not link. Repeated rows count each. A row without id links with its equals
    only by class, has a null component if no equal has an id, and is never kept. Other columns are ignored; no rows give no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    good &= F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(good & F.exists("embedding", lambda x: x != 0), F.lit(False))
    valid, rest = rows.filter(good), rows.filter(~good)
    classes = valid.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    coded = stored(_coded(classes.filter("node is not null").select("node", "weight", "embedding")), "coded")

    entered = coded.select("node", F.posexplode("own").alias("table", "cell"), F.lit(True).alias("home"))
    width = 2 * NEIGHBOURS
    asked = coded.select("node", F.posexplode("near").alias("k", "cell")).select(
        "node", F.expr(f"cast(k div {width} as int)").alias("table"), "cell", F.lit(False).alias("home")
    )
    entries = entered.unionByName(asked)
    met = entries.groupBy("table", "cell").agg(F.count("*").alias("n"), F.max("home").alias("any")).filter("n > 1 and any").drop("any")
    blocks = F.ceil(F.col("n") / BLOCK)
    members = entries.join(met, ["table", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("node"), blocks))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    members = members.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    block = ["table", "cell", "i", "j"]
    wide = coded.select("node", "weight", "vector", F.col("own_bytes").alias("own"), F.col("near_bytes").alias("near"))
    members = members.select(*block, "node", "home", "chunk").join(wide, "node").repartition(*block).sortWithinPartitions(*block)
    found = members.select(*block, "node", "home", "chunk", "weight", "vector", "own", "near").mapInArrow(
        _compare(threshold), "node long, links long, head long"
    )
    found = stored(found, "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(found.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    placed = classes.join(links, "node", "left").join(components, "node", "left").select(
        "embedding",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    result = valid.join(placed, "embedding").select("vec_id", "n_links", "component_id")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
