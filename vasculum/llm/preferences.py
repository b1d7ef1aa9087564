"""Preference formatting of conversations, with DataFrame functions alone.

The longest common turn prefix of a chosen and a rejected conversation is rendered once, as the prompt; what follows on either side
becomes a completion with the spans on which it is trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn format (fixed values).
START, END = "<|im_start|>", "<|im_end|>"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(f"{END}\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _spans(turns: Column) -> Column:
    """Spans (start, length), in characters of the rendered turns, of the assistant's texts and the marker that ends them."""

    def step(done: Column, turn: Column) -> Column:
        head = F.length(turn["role"]) + len(START) + 1
        body = F.length(turn["text"]) + len(END)
        span = F.struct((done["at"] + head).alias("start"), body.alias("length"))
        spans = F.when(turn["role"] == "assistant", F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((done["at"] + head + body + 1).alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return F.aggregate(turns, begin, step, lambda done: done["spans"])


def format_preferences(turns: DataFrame) -> DataFrame:
    """Rows (pair_id, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans, usable) from rows (pair_id, side, turn, role, text).

    side is `chosen` or `rejected`; other rows are left out. Turns are ordered by turn, role and text; a null turn comes first, a null role counts as `user`, a
    null text as empty. Markers inside texts and roles lose their bar, so a text cannot end its turn. Turns are equal if role and text are. A pair is
    usable if both completions hold an assistant's turn. A missing side is an empty conversation. Repeated rows are repeated turns; a null pair_id
    is a pair like any other; other columns are ignored; no rows give no rows. Memory: a task holds one pair's turns at a time.
    """

    def clean(column: str, default: str) -> Column:
        return F.regexp_replace(F.coalesce(F.col(column).cast("string"), F.lit(default)), r"<\|(im_start|im_end)\|>", "<$1>")

    rows = turns.filter(F.col("side").isin("chosen", "rejected")).select(
        "pair_id", "side", F.struct(F.col("turn").cast("long").alias("turn"), clean("role", "user").alias("role"), clean("text", "").alias("text")).alias("t")
    )
    sides = [
        F.array_sort(F.collect_list(F.when(F.col("side") == side, F.col("t")))).alias(side) for side in ("chosen", "rejected")
    ]
    pairs = rows.groupBy("pair_id").agg(*sides).withColumn("least", F.least(F.size("chosen"), F.size("rejected")))
    same = F.filter(
        F.sequence(F.lit(0), F.col("least")),
        lambda i: (i == F.col("least")) | (F.get("chosen", i)["role"] != F.get("rejected", i)["role"]) | (F.get("chosen", i)["text"] != F.get("rejected", i)["text"]),
    )
    pairs = pairs.withColumn("n_common", F.array_min(same))
    tails = {side: F.slice(side, F.col("n_common") + 1, F.size(side) + 1) for side in ("chosen", "rejected")}
    pairs = pairs.select("pair_id", "n_common", F.slice("chosen", F.lit(1), F.col("n_common")).alias("head"), *[x.alias(s) for s, x in tails.items()])
    answered = [F.exists(s, lambda t: t["role"] == "assistant") for s in tails]
    return pairs.select(
        "pair_id", F.col("n_common").cast("long").alias("n_common"),
        _joined(F.col("head")).alias("prompt"), _joined(F.col("chosen")).alias("chosen"), _joined(F.col("rejected")).alias("rejected"),
        _spans(F.col("chosen")).alias("chosen_spans"), _spans(F.col("rejected")).alias("rejected_spans"), (answered[0] & answered[1]).alias("usable"),
    )
