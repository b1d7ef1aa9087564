"""Quality by nearest-neighbour voting in a latent-semantic space.

Labelled documents become weighted term vectors, a truncated singular value decomposition turns them
into short latent vectors, and these are broadcast. Every document is put into the same space, its cosines
with all labelled vectors are computed exactly, block by block, and its nearest neighbours vote with their
labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vasculum.llm.storage import in_parts, stored

#: At most so many distinct labelled texts of each label are learned from, drawn by a hash of text: bounds the model and what the driver gathers.
LEARN_DOCUMENTS = 1_500
LATENT, NEIGHBOURS, BLOCK = 40, 25, 512
#: Term slots: hashed letter trigrams, hashed trigrams of character kinds, repetition.
LETTER_SLOTS, KIND_SLOTS, REPEAT_SLOTS = 512, 512, 30
SLOTS = LETTER_SLOTS + KIND_SLOTS + REPEAT_SLOTS
SHARPNESS = 8
PART_CHARS = 1_000_000


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Code point to lower-cased code point, and to its kind: letters and digits share kinds, other ASCII characters have their own."""
    points = np.arange(0x250)
    low = np.array([ord(chr(i).lower()[0]) for i in points], np.uint64)
    kind = np.array(
        [1 if chr(i).islower() else 2 if chr(i).isupper() else 3 if chr(i).isdigit() else i if i < 128 else 4 for i in points], np.uint64
    )
    return np.append(low, np.uint64(0x250)), np.append(kind, np.uint64(5))


def _hashed(codes: np.ndarray, slots: int) -> np.ndarray:
    grams = codes[:-2] << np.uint64(42) ^ codes[1:-1] << np.uint64(21) ^ codes[2:]
    return np.bincount((grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % slots, minlength=slots)


def _repeats(parts: list[str], slots: int) -> np.ndarray:
    """Slots that say which share of the parts repeats an earlier one, and which repeats the one before it."""
    out = np.zeros(2 * slots)
    if len(parts) > 1:
        out[min(slots - 1, int(slots * (1 - len(set(parts)) / len(parts))))] = len(parts)
        out[slots + min(slots - 1, int(slots * sum(map(eq, parts, parts[1:])) / (len(parts) - 1)))] = len(parts)
    return out


def term_vector(text: str) -> np.ndarray:
    """Dampened term shares of a whole text; zero if it is empty."""
    if not text:
        return np.zeros(SLOTS, np.float32)
    low, kind = _tables()
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0x250)
    ends = np.array([32, 32], np.uint64)
    terms = []
    for codes, slots in ((low[points], LETTER_SLOTS), (kind[points], KIND_SLOTS)):
        found = _hashed(np.concatenate([ends[:1], codes, ends]), slots)
        terms.append(np.sqrt(found / found.sum()))
    words = _repeats(text.split(), 10)
    lines = _repeats([x for x in text.split("\n") if x], 5)
    return np.concatenate([*terms, 0.7 * np.sign(words), 0.5 * np.sign(lines)]).astype(np.float32)


class Voter:
    """The model: term weights, projection, labelled latent vectors."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray):
        found = (terms > 0).sum(axis=0)
        self.weights = np.log((1 + len(terms)) / (1 + found)).clip(0.3).astype(np.float32)
        self.mean = (terms * self.weights).mean(axis=0)
        weighted = terms * self.weights - self.mean
        _, vectors = np.linalg.eigh(weighted.T.astype(np.float64) @ weighted)
        self.projection = vectors[:, ::-1][:, :LATENT].astype(np.float32)
        self.labels = labels.astype(np.float64)
        self.latent = self._unit(weighted @ self.projection).T.copy()

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Weighted share of neighbours with label 1; 0 for texts that are null or empty."""
        out = np.zeros(len(texts))
        full = [i for i, t in enumerate(texts) if t]
        for a in range(0, len(full), BLOCK):
            block = full[a : a + BLOCK]
            terms = np.stack([term_vector(texts[i]) for i in block])
            cosine = self._unit((terms * self.weights - self.mean) @ self.projection) @ self.latent
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosine, near, axis=1).astype(np.float64), 1e-3) ** SHARPNESS
            out[block] = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return np.clip(out, 0, 1)


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text") -> Voter | None:
    """Model from the labelled rows where `may_learn` holds; None if there are none.

    Rows without text, id or label teach nothing. Rows are first summed by text hash and label, so that a text counts once however many rows hold it; one
    that bears both labels votes for each by its share of them. Of each label, the LEARN_DOCUMENTS distinct texts of the least hashes are taken, so at most
    2 x LEARN_DOCUMENTS term vectors come to the driver.
    """
    marks = labels.select(F.col(id_col).alias("mark_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)")
    rows = docs.filter(may_learn & (F.length(text_col) > 0)).select(F.col(id_col).alias("mark_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    summed = rows.select("mark_id", "hash").join(marks, "mark_id").groupBy("hash").agg(
        F.min("mark_id").alias("mark_id"), *[F.sum(F.when(F.col("quality") == k, 1).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
    )
    summed = stored(summed, "labelled-texts")  # four numbers a text
    counts = summed.agg(*[F.sum((F.col(f"n{k}") > 0).cast("long")).alias(f"n{k}") for k in (0, 1)]).first()
    draw = F.pmod("hash", F.lit(1_000_000))
    drawn = {}
    for k in (0, 1):
        # Twice the share, then exactly the least: few rows meet in the sort, and the bound holds whatever the hashes are.
        near = summed.filter((F.col(f"n{k}") > 0) & (draw < max(1_000, int(2e6 * LEARN_DOCUMENTS / max(counts[f"n{k}"] or 0, 1)))))
        drawn |= {r["hash"]: r for r in near.orderBy(draw, "hash").limit(LEARN_DOCUMENTS).collect()}
    if not drawn:
        return None
    picked = docs.sparkSession.createDataFrame([(r["mark_id"], h) for h, r in drawn.items()], summed.select("mark_id", "hash").schema)
    rows = rows.join(F.broadcast(picked), ["mark_id", "hash"]).groupBy("hash").agg(F.min("text").alias("text"))  # an id and its text may be repeated

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [term_vector(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.binary())], ["hash", "terms"])

    found = []
    for r in rows.mapInArrow(run, "hash long, terms binary").collect():
        n = drawn[r["hash"]]
        found.append((bytes(r["terms"]), n["n1"] / (n["n0"] + n["n1"])))
    found.sort()
    return Voter(np.stack([np.frombuffer(t, np.float32) for t, _ in found]), np.array([q for _, q in found]))


def classify(docs: DataFrame, voter: Voter | None, text_col: str = "text", threshold: float = 0.7, only_good: bool = False) -> DataFrame:
    """The rows with score and predicted (1 if score >= threshold); with `only_good`, the unchanged rows predicted 1.

    Null and empty texts score 0. Without a model every other text scores 0.5, and `only_good` keeps all rows, since nothing is known against
    them. Equal texts get equal scores. Columns score and predicted that `docs` has already are replaced.
    """
    docs = docs if only_good else docs.drop("score", "predicted")
    at = docs.columns.index(text_col)
    model = docs.sparkSession.sparkContext.broadcast(voter)  # about 1 MB, by LEARN_DOCUMENTS and SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = model.value
        for batch in batches:
            for rows in in_parts(batch, at, PART_CHARS):
                texts = rows.column(at).to_pylist()
                scores = voter.scores(texts) if voter else np.array([0.5 if t else 0.0 for t in texts])
                good = scores >= threshold
                if only_good:
                    yield rows.filter(pa.array(good if voter else np.ones(len(texts), bool)))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(scores, pa.float64()), pa.array(good.astype(np.int32))], [*rows.schema.names, "score", "predicted"]
                    )

    if only_good:
        return docs.mapInArrow(run, docs.schema)
    return docs.mapInArrow(run, docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)
