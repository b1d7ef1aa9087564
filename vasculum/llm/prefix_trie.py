"""Prefix trie of conversations by the recursion of van Emde Boas.

A block of the trie covers a power of two of depths. It is cut at half its depth: the prefixes that end at the cut are
named by their content, without waiting for the names above, so that the upper trie and the lower forests, one below each cut prefix, are built side
by side, each cut again in the same way. All blocks of one size are worked on at once, so the rounds grow with the logarithm of the
longest conversation. Totals go the other way: what a lower forest holds is grafted on its cut prefix and from there counts for the path
above it. Blocks of CHUNK turns are cut inside one row; larger ones by joins of their halves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vasculum.llm.storage import stored

#: Turns of a conversation that lie in one row; a power of two.
CHUNK = 32
#: Ids that share all but so many low bits have their decimal forms joined in one row: 8,192 at most.
END_BITS = 13
#: Characters of a text that order turns of the same number and role; beyond them their hash does.
HEAD_CHARS = 32
WORD = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.md5(b"root").digest()
TURN = "array<struct<t: binary, words: long>>"


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns_in_order(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (conv, pos, t, words): turns numbered from 0, t naming role and text, without rows of a null conversation.

    Sorted by ranges, so that a conversation of any length is spread over tasks; a task numbers its part of the one conversation that
    reaches into it from the parts before.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.left(text, F.lit(HEAD_CHARS)).alias("head"),
        F.md5(text).alias("hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv", "turn", "role", "head", "hash"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("conv", _digest(F.md5("role"), F.col("hash")).alias("t"), "words")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, so_far = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            new = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]]) if len(conv) else np.zeros(0, bool)
            at = np.arange(len(conv))
            first = np.maximum.accumulate(np.where(new, at, -1))
            pos = np.where(first < 0, at + so_far, at - first)
            if len(conv):
                last, so_far = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pos, pa.int64()), pa.array(np.full(len(conv), part), pa.int64()), batch.column(1), batch.column(2)],
                ["conv", "pos", "part", "t", "words"],
            )

    local = stored(ranged.mapInArrow(number, "conv long, pos long, part long, t binary, words long"), "turns")
    parts = local.groupBy("conv", "part").agg(F.max("pos").alias("most"))
    along = Window.partitionBy("conv").orderBy("part")  # one row a task that the conversation reaches
    before = F.sum(F.col("most") + 1).over(along.rowsBetween(Window.unboundedPreceding, -1))
    shifted = parts.select("conv", "part", before.alias("before")).filter("before is not null")  # one row a task at most
    return local.join(F.broadcast(shifted), ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "t", "words"
    )


def rebuilt(turns: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """Rows (conv, pos, t, words) of conversations that begin with the first turns of another, and a root at pos 0 of each.

    Conversation c gets the first h = crc32(c) % shared turns of c - c % group and goes on with its own after its first h.
    """
    few = shared - 1
    bases = turns.filter((F.col("conv") % group == 0) & (F.col("pos") < few)).groupBy("conv").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "t", "words"))), lambda x: F.struct(x["t"].alias("t"), x["words"].alias("words"))).alias("pre")
    )
    base = F.col("conv") - F.col("conv") % group
    h = F.when(base == F.col("conv"), 0).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % shared).cast("int")
    own = turns.withColumns({"base": base, "h": h}).join(bases.withColumnRenamed("conv", "base"), "base", "left")
    own = own.withColumn("pre", F.slice(F.coalesce("pre", F.array().cast(TURN)), F.lit(1), F.col("h")))

    def entry(pos: Column, t: Column, words: Column) -> Column:
        return F.struct(pos.cast("long").alias("pos"), t.alias("t"), words.cast("long").alias("words"))

    nothing = F.array().cast("array<struct<pos: long, t: binary, words: long>>")
    root = F.array(entry(F.lit(0), F.lit(ROOT), F.lit(0)))
    start = F.concat(root, F.transform("pre", lambda x, i: entry(i + 1, x["t"], x["words"])))
    kept = F.array(entry(F.col("pos") - F.col("h") + F.size("pre") + 1, F.col("t"), F.col("words")))
    made = F.concat(F.when(F.col("pos") == 0, start).otherwise(nothing), F.when(F.col("pos") >= F.col("h"), kept).otherwise(nothing))
    return own.select("conv", F.explode(made).alias("x")).select("conv", "x.pos", "x.t", "x.words")


def block_content(turns: list[bytes]) -> bytes:
    """Content of a whole block of turns."""
    return hashlib.md5(b"".join(turns)).digest()


def prefix_names(above: bytes, turns: list[bytes], height: int = CHUNK) -> list[bytes]:
    """Names of the prefixes that end in a block of this height, which hangs below the prefix `above`."""
    if height == 1 or not turns:
        return [hashlib.md5(above + t).digest() for t in turns]
    half = height // 2
    upper = prefix_names(above, turns[:half], half)
    if len(turns) <= half:
        return upper
    cut = hashlib.md5(above + block_content(turns[:half])).digest()
    return upper + prefix_names(cut, turns[half:], half)


def _halving(
    blocks: DataFrame, join: Callable[[Column, Column], Column], start: Column,
    upper: Callable[[Column, Column, Column], Column], lower: Callable[[Column, Column, Column], Column],
) -> DataFrame:
    """Rows (conv, k, given): what each block gets from the recursion over pairs of blocks.

    blocks: (conv, k, value), k counting a conversation's blocks from 0. Going up, two halves' values are joined. Going down, the whole
    begins with `start`, and the halves of a block get upper and lower(given, left value, right value).
    """
    levels, most = [], blocks.agg(F.max("k")).first()[0] or 0
    level = blocks.select("conv", "k", "value")
    for _ in range(int(most).bit_length()):
        odd = F.col("k") % 2 == 1
        level = stored(
            level.groupBy("conv", F.shiftright("k", 1).alias("k")).agg(
                F.max(F.when(~odd, F.col("value"))).alias("left"), F.max(F.when(odd, F.col("value"))).alias("right"), F.count_if(odd).alias("lowers")
            ).withColumn("value", join(F.col("left"), F.col("right"))),
            "halves",
        )
        levels.append(level)
    if not levels:
        return blocks.select("conv", "k", start.alias("given"))
    given = levels[-1].select("conv", "k", start.alias("given"))
    for level in reversed(levels):
        both = level.join(given, ["conv", "k"]) if level is not levels[-1] else level.withColumn("given", start)
        at = (F.col("given"), F.col("left"), F.col("right"))
        halves = F.array(F.struct((2 * F.col("k")).alias("k"), upper(*at).alias("given")))
        two = F.concat(halves, F.array(F.struct((2 * F.col("k") + 1).alias("k"), lower(*at).alias("given"))))
        given = both.select("conv", F.explode(F.when(F.col("lowers") > 0, two).otherwise(halves)).alias("x")).select("conv", "x.k", "x.given")
        given = stored(given, "given")
    return given


def _paths(sequences: DataFrame) -> DataFrame:
    """Rows (conv, k, names, above, words, last): the names of the prefixes that end in each chunk of a conversation's turns.

    above is the name of the prefix before the chunk, last whether the conversation ends in it.
    """
    turn = F.struct("pos", "t", "words")
    chunks = sequences.groupBy("conv", F.shiftright("pos", CHUNK.bit_length() - 1).alias("k")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))  # CHUNK at most

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The chunk's own names below a given prefix; without one, its content.
        for batch in batches:
            turns = batch.column(2).to_pylist()
            if batch.num_columns == 3:
                found = [block_content(x) if len(x) == CHUNK else None for x in turns]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["conv", "k", "value"])
            else:
                found = [prefix_names(above, x) for above, x in zip(batch.column(4).to_pylist(), turns, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.binary())), *batch.columns[3:]], ["conv", "k", "names", "words", "above"])

    chunks = stored(chunks.select("conv", "k", F.col("turns.t").alias("t"), F.col("turns.words").alias("words")), "chunks")
    long_ = chunks.filter("k > 0").select("conv").distinct()
    first = chunks.join(long_, "conv", "left_anti").withColumn("above", F.lit(b"").cast("binary"))
    # Only conversations of more than one chunk need the blocks above chunks.
    longer = chunks.join(long_, "conv", "left_semi")
    content = longer.select("conv", "k", "t").mapInArrow(name, "conv long, k long, value binary")
    above = _halving(
        content, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), _digest(a, b)), F.lit(b"").cast("binary"),
        lambda given, left, right: given, lambda given, left, right: _digest(given, left),
    )
    longer = longer.join(above.withColumnRenamed("given", "above"), ["conv", "k"])
    ready = first.select("conv", "k", "t", "words", "above").unionByName(longer.select("conv", "k", "t", "words", "above"))
    named = ready.mapInArrow(name, "conv long, k long, names array<binary>, words array<long>, above binary")
    return stored(named, "paths")


def _grafted(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (name, leaves, saved): the totals of each node's subtree.

    A node's own values lie on the path of its smallest member, which passes through all nodes above it. On a path, what lies below the
    cut of a block is grafted on every turn above it, block by block; then the paths that meet in a node are added.
    """
    own = nodes.select(
        F.col("conv_id").alias("conv"), F.shiftright("depth", CHUNK.bit_length() - 1).alias("k"), (F.col("depth") % CHUNK).alias("at"), "leaf", "saved"
    ).groupBy("conv", "k").agg(F.collect_list(F.struct("at", F.col("leaf").cast("long").alias("leaves"), "saved")).alias("own"))  # CHUNK at most
    both = paths.select("conv", "k", "names").join(own, ["conv", "k"], "left")

    def graft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, saved = np.zeros((2, batch.num_rows, CHUNK), np.int64)
            for row, own in enumerate(batch.column(3).to_pylist()):
                for x in own or ():
                    leaves[row, x["at"]], saved[row, x["at"]] = x["leaves"], x["saved"]
            half = 1
            while half < CHUNK:
                for total in (leaves, saved):
                    blocks = total.reshape(batch.num_rows, -1, 2 * half)
                    blocks[:, :, :half] += blocks[:, :, half : half + 1]
                half *= 2
            totals = [pa.array(list(x), pa.list_(pa.int64())) for x in (leaves, saved)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *totals], ["conv", "k", "names", "leaves", "saved"])

    inside = stored(both.mapInArrow(graft, "conv long, k long, names array<binary>, leaves array<long>, saved array<long>"), "grafts")
    long_ = inside.filter("k > 0").select("conv").distinct()
    # What lies in the chunks below a chunk is grafted on all of it.
    sums = inside.join(long_, "conv", "left_semi").select("conv", "k", F.struct(F.col("leaves")[0].alias("leaves"), F.col("saved")[0].alias("saved")).alias("value"))

    def added(a: Column, b: Column) -> Column:
        return F.struct(*[(F.coalesce(a[x], F.lit(0)) + F.coalesce(b[x], F.lit(0))).alias(x) for x in ("leaves", "saved")])

    zero = F.struct(F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    below = _halving(sums, added, zero, lambda given, left, right: added(given, right), lambda given, left, right: given)
    all_ = inside.join(below, ["conv", "k"], "left")
    entry = F.transform("names", lambda name, i: F.struct(
        name.alias("name"), *[(F.get(x, i) + F.coalesce(F.col("given")[x], F.lit(0))).alias(x) for x in ("leaves", "saved")]
    ))
    # Entries without a value, as all those of a copy, add nothing.
    some = F.filter(entry, lambda x: (x["leaves"] > 0) | (x["saved"] > 0))
    return all_.select(F.explode(some).alias("x")).groupBy("x.name").agg(F.sum("x.leaves").alias("leaves"), F.sum("x.saved").alias("saved"))


def _ends(paths: DataFrame) -> DataFrame:
    """Rows (name, ends_sha256) of the nodes at which conversations end.

    Ids are joined in short runs; a node of one run is hashed in place, the runs of the others are sorted and go through the hash as a stream.
    """
    last = paths.groupBy("conv").agg(F.max_by(F.element_at("names", -1), "k").alias("name"))
    ids = last.groupBy("name", F.shiftright("conv", END_BITS).alias("run")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    runs = stored(ids.select("name", "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")), "ends")
    many = runs.groupBy("name").agg(F.count("*").alias("runs")).filter("runs > 1").select("name")
    few = runs.join(many, "name", "left_anti").select("name", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.string()]
        name, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if own != name:
                    if name is not None:
                        done.append((name, state.hexdigest()))
                    name, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], ["name", "ends_sha256"])
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], kinds[0]), pa.array([state.hexdigest()], kinds[1])], ["name", "ends_sha256"])

    sorted_ = runs.join(many, "name", "left_semi").repartition("name").sortWithinPartitions("name", "run").select("name", "ids")
    return few.unionByName(sorted_.mapInArrow(hashed, "name binary, ends_sha256 string"))


def trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences (conv, pos, t, words), which begin at pos 0 with a row that all share.

    Returns (name, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row a node: its smallest
    member, depth, its parent's smallest member, members, children, childless nodes in its subtree, the words that its subtree's members need
    not repeat, and the hash of the ids that end here. No sequences give no nodes. Copies and common prefixes are counted before the shuffle.
    """
    paths = _paths(sequences)
    place = F.transform("names", lambda name, i: F.struct(
        name.alias("name"), (F.col("k") * CHUNK + i).alias("depth"), F.get("words", i).alias("words"),
        F.when(i > 0, F.get("names", i - 1)).alias("parent"), (i == F.size("names") - 1).alias("edge"),
    ))
    # Chunks below the first take their parent, and whether their conversation goes on, from their neighbour.
    edges = paths.filter("k > 0").select("conv", (F.col("k") - 1).alias("k"), F.lit(True).alias("more"))
    tops = paths.select("conv", (F.col("k") + 1).alias("k"), F.element_at("names", -1).alias("top")).join(
        paths.filter("k > 0").select("conv", "k"), ["conv", "k"], "left_semi"
    )
    linked = paths.join(edges.unionByName(tops, allowMissingColumns=True).groupBy("conv", "k").agg(F.max("more").alias("more"), F.max("top").alias("top")), ["conv", "k"], "left")
    steps = linked.select("conv", "top", "more", F.explode(place).alias("x")).select(
        "conv", "x.name", "x.depth", "x.words", F.coalesce("x.parent", "top").alias("parent"), (~F.col("x.edge") | F.coalesce("more", F.lit(False))).alias("goes_on")
    )
    nodes = steps.groupBy("name").agg(
        F.min("conv").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.count("*").alias("n_convs"), F.max("words").alias("words"), (~F.max("goes_on")).alias("leaf"),
    )
    nodes = stored(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    # A node and its parent have the same smallest member, but for the first node of each member's own branch.
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    facts = nodes.select("name", "conv_id", "depth", "parent", "n_convs").unionByName(children, allowMissingColumns=True)
    facts = facts.unionByName(_grafted(paths, nodes), allowMissingColumns=True).unionByName(_ends(paths), allowMissingColumns=True)
    found = facts.groupBy("name").agg(*[F.max(c).alias(c) for c in facts.columns if c != "name"])
    out = found.join(parents, "parent", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "name", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("leaves", zero).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of rebuilt conversations (see `rebuilt`), one row a node.

    Turns go by number, null first; those of the same number by role, the first HEAD_CHARS characters of text, and the hash of text;
    repeated rows are turns of their own. A null role or text is empty. Rows without a conversation id belong to none and are left out. A
    conversation whose turns are all replaced by none ends at the root. Other columns are ignored; no rows give no nodes.
    """
    return trie(rebuilt(turns_in_order(conversations, conv_col, turn_col, role_col, text_col)))


#: DuckDB: every prefix of every rebuilt conversation, compared as a list.
SQL = r"""
with recursive turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), left(coalesce(text, ''), 32), md5(coalesce(text, ''))) - 1 as pos,
    md5(coalesce(role, '')) || md5(coalesce(text, '')) as t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as words
  from conversations where conv_id is not null
), bits(conv_id, rest, step, crc) as (
  select distinct conv_id, conv_id::varchar, 0, 4294967295::bigint from turns
  union all
  select conv_id, case when step % 9 = 0 then substr(rest, 2) else rest end, step + 1,
    case when step % 9 = 0 then xor(crc, ascii(rest)::bigint) else xor(crc >> 1, (crc & 1) * 3988292384) end
  from bits where not (rest = '' and step % 9 = 0)
), heads as (
  select conv_id, conv_id - conv_id % 20 as base,
    case when conv_id % 20 = 0 then 0 else xor(arg_max(crc, step), 4294967295) % 4 end as h
  from bits group by conv_id
), whole as (
  select h.conv_id, list(struct_pack(t := b.t, w := b.words) order by b.part, b.pos) filter (where b.t is not null) as turns
  from heads h left join (
    select h.conv_id, 0 as part, t.pos, t.t, t.words from heads h join turns t on t.conv_id = h.base and t.pos < h.h
    union all
    select h.conv_id, 1, t.pos, t.t, t.words from heads h join turns t on t.conv_id = h.conv_id and t.pos >= h.h
  ) b on b.conv_id = h.conv_id
  group by h.conv_id
), steps as (
  select conv_id, coalesce(turns, []) as turns, unnest(range(0, coalesce(len(turns), 0) + 1)) as depth from whole
), prefixes as (
  select *, list_transform(turns[1:depth], lambda x: x.t) as prefix from steps
), nodes as (
  select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs, max(len(turns)) = depth as leaf, max(case when depth > 0 then turns[depth].w else 0 end) as words,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(turns) = depth), '')) as ends_sha256
  from prefixes group by prefix, depth
), totals as (
  select p.prefix, count(*) filter (where n.leaf) as n_leaves, sum((n.n_convs - 1) * n.words)::bigint as saved_tokens
  from nodes n join prefixes p on p.conv_id = n.conv_id and p.depth <= n.depth group by p.prefix
), children as (
  select prefix[1:depth - 1] as prefix, count(*) as n_children from nodes where depth > 0 group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::bigint as n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
from nodes n join totals t using (prefix) left join children c using (prefix)
left join nodes p on n.depth > 0 and p.prefix = n.prefix[1:n.depth - 1]
"""
