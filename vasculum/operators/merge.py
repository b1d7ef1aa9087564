"""Merging the records of a group into one, column by column.

There is one kernel, `merge_group`; what differs between the many merges of the
pipeline is only a table of rules (which column is taken from the first record, which
from the last, which is joined) and the order that says who is first.

Rows are laid out by key and sorted, the keys with very many rows by ranges of key and order. Each Arrow batch of them is merged by itself, so a group is merged
in slices of a batch's rows at most, on whatever tasks its rows lie. Slices at the edge of a batch, two a batch, meet in
a small aggregate, which puts the text of a joined cell together from its slices.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from vasculum.operators.groups import Parts, batches_by_rows, in_pieces, materialise, run_starts, runs_in_parts, together
from vasculum.schema import separator

# What tasks run is sent along, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Rule:
    kind: str
    text: str | None = None
    order: tuple[Column, ...] | None = None
    source: str | None = None


def first(source: str | None = None, order: list[Column] | None = None) -> Rule:
    """First value present in the merge order, or in an order of its own."""
    return Rule("first", order=tuple(order) if order else None, source=source)


def last(source: str | None = None) -> Rule:
    """Last value present."""
    return Rule("last", source=source)


def join(sep: str, source: str | None = None) -> Rule:
    """All values present, in order."""
    return Rule("join", sep, source=source)


def join_or_null(sep: str, source: str | None = None) -> Rule:
    """All values in order, or null when any record lacks one."""
    return Rule("join_or_null", sep, source=source)


def const(value: str) -> Rule:
    return Rule("const", value)


def mean(source: str | None = None) -> Rule:
    return Rule("mean", source=source)


def variance(source: str) -> Rule:
    return Rule("variance", source=source)


def size() -> Rule:
    return Rule("size")


def joined(column: str) -> Rule:
    return join(separator(column))


def joined_or_null(column: str) -> Rule:
    return join_or_null(separator(column))


def expert_first(flag: str = "expert_det") -> Column:
    return F.when(F.col(flag).isNotNull(), 0).otherwise(1)


def ascending_nulls_last(c: str) -> list[Column]:
    return [F.col(c).isNull(), F.col(c)]


def newest_first(c: str = "det_year") -> list[Column]:
    return [F.col(c).isNull(), -F.col(c)]


CELL_KINDS = ("join", "join_or_null")


@dataclass(frozen=True)
class _Plan:
    """What a task does with a batch: the number of key columns, rules by output column, and the columns of each order of its own."""

    keys: int
    rules: dict[str, tuple[str, str, str | None, int | None]]
    orders: tuple[tuple[str, ...], ...]


def _of_its_own(table: pa.RecordBatch, group: np.ndarray, order: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(rows in the order of group and `order`, each row's place in it)."""
    keys = pa.table([pa.array(group), *[table.column(c) for c in order]], names=["_group", *order])
    sorted_ = pc.sort_indices(keys, [(c, "ascending") for c in ("_group", *order)], null_placement="at_start").to_numpy()
    place = np.empty(len(sorted_), np.int64)
    place[sorted_] = np.arange(len(sorted_))
    return sorted_, place


def _merge_batch(batch: pa.RecordBatch, plan: _Plan, slice_: int) -> list[pa.Array]:
    """One row for each run of equal keys in the batch: keys, slice, whether the run touches an edge, and what each rule needs."""
    rows = batch.num_rows
    keys = [batch.column(f"_k{i}") for i in range(plan.keys)]
    starts = run_starts(keys, rows)
    sizes = np.diff(np.append(starts, rows))
    group = np.repeat(np.arange(len(starts)), sizes)
    edge = np.zeros(len(starts), bool)
    edge[[0, -1]] = True
    out = [k.take(pa.array(starts)) for k in keys]
    out += [pa.array(np.full(len(starts), slice_), pa.int64()), pa.array(edge)]
    orders = [_of_its_own(batch, group, order) for order in plan.orders]
    valid_of = {source: batch.column(source).is_valid().to_numpy(zero_copy_only=False) for _, source, _, _ in plan.rules.values() if source}
    for kind, source, separator, own in plan.rules.values():
        if kind == "size":
            out.append(pa.array(sizes.astype(np.int64)))
            continue
        column, valid = batch.column(source), valid_of[source]
        if kind in ("first", "last"):
            if kind == "last":
                best = np.maximum.reduceat(np.where(valid, np.arange(rows), -1), starts)
                none = best < 0
            elif own is None:
                best = np.minimum.reduceat(np.where(valid, np.arange(rows), rows), starts)
                none = best == rows
            else:
                sorted_, place = orders[own]
                best = np.minimum.reduceat(np.where(valid, place, rows), starts)
                none = best == rows
                best = sorted_[np.where(none, 0, best)]
            found = pa.array(np.where(none, 0, best), mask=none)
            out.append(column.take(found))
            if own is not None:
                parts = [batch.column(c).take(found) for c in plan.orders[own]]
                out.append(pa.StructArray.from_arrays(parts, [f"c{i}" for i in range(len(parts))]))
        elif kind in CELL_KINDS:
            counts = np.add.reduceat(valid.astype(np.int64), starts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            text = pc.binary_join(pa.ListArray.from_arrays(offsets, column.filter(pa.array(valid))), separator)
            out.append(pc.if_else(pa.array(counts > 0), text, pa.scalar(None, text.type)))
            if kind == "join_or_null":
                out.append(pa.array(counts == sizes))
        else:  # mean, variance
            counts = np.add.reduceat(valid.astype(np.int64), starts)
            values = np.where(valid, column.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False), 0)
            means = np.add.reduceat(values, starts) / np.maximum(counts, 1)
            squares = np.add.reduceat(np.where(valid, (values - means[group]) ** 2, 0), starts)
            out += [pa.array(counts), pa.array(means), pa.array(squares)]
    return out


def merge_some(df: DataFrame, keys: list[str], order: list[Column], rules: dict[str, Rule], some: Column) -> tuple[DataFrame, DataFrame]:
    """(`some` of the rows merged, the others as they are), from rows that are written once."""
    parts, merged, others = Parts(df, keys), [], []
    for part in parts.each():
        rows = part if parts.many else materialise(part)
        merged.append(merge_group(rows.filter(some), keys, order, rules, stored=True, short=parts.short))
        others.append(parts.written(rows.filter(~some)))
    return together(merged), together(others)


def merge_group(
    df: DataFrame, keys: list[str], order: list[Column], rules: dict[str, Rule], stored: bool = False, short: bool = False
) -> DataFrame:
    """One record per key, null equal to null. `order` must be total within a group:
    its terms ascend, nulls first. The output has the columns of `rules`, written once to the checkpoint folder.

    Rows are written before, unless they are `stored`: read from files and changed row by row at most; whether those are `short` is not
    looked up (`batches_by_rows`).
    They are shuffled once (`runs_in_parts`), so a large group is spread over tasks and no task holds more of a group
    than a batch of rows. Joined cells are whole whatever their size: each is put together from the texts of its slices.
    """
    default = str(order)
    own: dict[str, int] = {}
    terms: list[tuple[Column, ...]] = []
    plan: dict[str, tuple[str, str, str | None, int | None]] = {}
    for name, rule in rules.items():
        if rule.kind == "const":
            continue
        index = None
        if rule.order and str(list(rule.order)) != default:
            key = str(list(rule.order))
            if key not in own:
                own[key] = len(terms)
                terms.append(rule.order)
            index = own[key]
        source = (rule.source or name) if rule.kind != "size" else ""
        plan[name] = (rule.kind, source, rule.text, index)
    # What is both a key, a term of an order and a rule's source is written and shuffled once.
    sources = list(dict.fromkeys(source for _, source, _, _ in plan.values() if source))
    sent = {str(F.col(s)): (s, F.col(s)) for s in sources}

    def once(column: Column, name: str) -> str:
        return sent.setdefault(str(column), (name, column))[0]

    by_key = [once(F.col(k), f"_k{i}") for i, k in enumerate(keys)]
    by_order = [once(o, f"_o{i}") for i, o in enumerate(order)]
    alike = [[once(c, f"_a{j}_{i}") for i, c in enumerate(term)] for j, term in enumerate(terms)]
    orders = [tuple(f"_a{j}_{i}" for i in range(len(term))) for j, term in enumerate(terms)]
    rows = df.select(*[c.alias(name) for name, c in sent.values()])
    renamed = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by_key)]
    renamed += [F.col(c).alias(a) for c, a in zip(sum(alike, []), sum(orders, ()), strict=True)]
    types = {f.name: f.dataType for f in rows.select(*renamed, *sources).schema}
    fields = [StructField(f"_k{i}", types[f"_k{i}"]) for i in range(len(keys))]
    fields += [StructField("_slice", LongType()), StructField("_edge", BooleanType())]
    for name, (kind, source, _, index) in plan.items():
        if kind == "size":
            fields.append(StructField("_v_" + name, LongType()))
        elif kind in ("mean", "variance"):
            fields += [StructField("_n_" + name, LongType()), StructField("_m_" + name, DoubleType()), StructField("_q_" + name, DoubleType())]
        else:
            fields.append(StructField("_v_" + name, types[source]))
            if index is not None:
                fields.append(StructField("_r_" + name, StructType([StructField(f"c{i}", types[c]) for i, c in enumerate(orders[index])])))
            if kind == "join_or_null":
                fields.append(StructField("_w_" + name, BooleanType()))
    work = _Plan(len(keys), plan, tuple(orders))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(piece for batch in batches for piece in in_pieces(batch)):
            yield pa.RecordBatch.from_arrays(_merge_batch(piece, work, part + number), names)

    slices = []
    for laid, by_rows in runs_in_parts(rows, by_key, by_order, stored, short):
        with batches_by_rows(df.sparkSession, by_rows):
            slices.append(materialise(laid.select(*renamed, *sources).mapInArrow(run, StructType(fields))))
    return _united(together(slices), [f"_k{i}" for i in range(len(keys))], rules, plan)


def _united(slices: DataFrame, keys: list[str], rules: dict[str, Rule], plan: dict) -> DataFrame:
    """Records from slices: those inside a batch are whole, those at its edges meet in an aggregate."""
    many, done, rest = [], [], []
    for name, rule in rules.items():
        value, filled = F.col("_v_" + name), F.col("_v_" + name).isNotNull()
        if rule.kind == "const":
            done.append(F.lit(rule.text).alias(name))
            rest.append(F.lit(rule.text).alias(name))
            continue
        if rule.kind in ("mean", "variance"):
            n, mean, squares = (F.col(x + name) for x in ("_n_", "_m_", "_q_"))
            # Slices' squares are moved from their own mean to that of all.
            whole = F.try_divide(F.sum(n * mean), F.sum(n))
            moved = F.greatest(F.sum(squares) + F.sum(n * mean * mean) - F.sum(n) * whole * whole, F.lit(0.0))
            if rule.kind == "mean":
                many.append(whole.alias("_v_" + name))
                done.append(F.when(n > 0, mean).alias(name))
            else:
                many.append(F.when(F.sum(n) > 1, moved / (F.sum(n) - 1)).alias("_v_" + name))
                done.append(F.when(n > 1, squares / (n - 1)).alias(name))
            rest.append(F.col("_v_" + name).alias(name))
            continue
        if rule.kind == "first":
            rank = F.struct(*(["_r_" + name] if plan[name][3] is not None else []), "_slice")
            many.append(F.min_by(value, F.when(filled, rank)).alias("_v_" + name))
        elif rule.kind == "last":
            many.append(F.max_by(value, F.when(filled, F.col("_slice"))).alias("_v_" + name))
        elif rule.kind == "size":
            many.append(F.sum(value).alias("_v_" + name))
        else:
            text = F.expr(f"listagg(`_v_{name}`, '{rule.text}') within group (order by _slice)")
            many.append((F.when(F.bool_and("_w_" + name), text) if rule.kind == "join_or_null" else text).alias("_v_" + name))
        complete = F.col("_w_" + name) if rule.kind == "join_or_null" else F.lit(True)
        done.append(F.when(complete, value).alias(name))
        rest.append(value.alias(name))
    inside = slices.filter(~F.col("_edge")).select(*done)
    at_edges = slices.filter("_edge").groupBy(*keys).agg(*many).select(*rest)
    return inside.unionByName(at_edges)
