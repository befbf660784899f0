"""Prefix trie of conversations: ROLLUP over columns of turn ids, block of turns after block of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

FAMILY, HEADS = 5, 9  # Fixed values: conversations that share a base, and the modulus of how many turns they share.
WIDTHS = (8, 16, 32)  # turns in a block of columns; later blocks have the last width
TURN_BITS, TIE_BYTES = 12, 2  # turns are numbered in blocks of 4096 turn numbers, those without a number by their id's first bytes
END_BITS = 12  # members of a node are listed in runs of 4096 ids
ROOT = "00" * 16  # name of the node without turns, in hex
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _empty() -> Column:
    return F.unhex(F.lit(""))


def turn_id() -> Column:
    """24 bytes that name a turn's role and text: their MD5, then the bytes of the text, which can be read back."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text).cast("bigint")), 16, "0")
    return F.unhex(F.concat(F.md5(named.cast("binary")), size))


def text_bytes(turn: Column) -> Column:
    """The bytes of the text behind a turn id."""
    return F.conv(F.hex(F.substring(turn, 17, 8)), 16, 10).cast("bigint")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, id``: the turns of each conversation counted from 1, by ``turn`` (null first), then by id.

    A conversation is numbered in blocks of turn numbers and the counts of its blocks are summed up, so
    an endless one is many tasks. Texts stay where they are read. Rows with a null ``conv_id`` belong to no conversation.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), turn_id().alias("id")
    )
    tie = F.conv(F.hex(F.substring("id", 1, TIE_BYTES)), 16, 10).cast("bigint")
    # Turns without a number come first and are ordered by their ids alone.
    block = F.when(F.col("turn").isNull(), tie - (1 << 60)).otherwise(F.shiftright("turn", TURN_BITS))
    cut = rows.withColumn("block", block)
    counts = cut.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "id")
    placed = cut.withColumn("at", F.row_number().over(inside)).join(starts, ["conv_id", "block"])
    return stored(placed.select("conv_id", (F.col("start") + F.col("at")).alias("pos"), "id"), "trie-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations to build the trie of, ``conv_id, n``, and their turns, ``conv_id, n, pos, id``.

    Conversation c starts with the first turns of c - c % 5, as many as a checksum of c says, and goes on with
    its own turns after as many.
    """
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("len"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("head")
    own = stored(own.select("conv_id", "len", head, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")), "trie-own")
    bases = own.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    shared = F.least(F.col("head"), F.coalesce("base_len", F.lit(0)))
    made = own.join(bases, "base", "left").withColumn("shared", shared)
    made = made.withColumn("n", F.col("shared") + F.greatest(F.col("len") - F.col("head"), F.lit(0)))
    made = stored(made.select("conv_id", "base", "head", "shared", "n"), "trie-conversations")
    first = turns.filter(F.col("pos") < HEADS).select(F.col("conv_id").alias("base"), "pos", "id")
    heads = first.join(made, "base").filter("pos <= head").select("conv_id", "n", "pos", "id")
    rest = turns.join(made, "conv_id").filter("pos > head")
    rest = rest.select("conv_id", "n", (F.col("shared") + F.col("pos") - F.col("head")).alias("pos"), "id")
    return made.select("conv_id", "n"), stored(heads.unionByName(rest), "trie-rebuilt")


def _columns(width: int) -> list[str]:
    return [f"t{i}" for i in range(1, width + 1)]


def block_rows(turns: DataFrame, before: DataFrame | None, start: int, width: int) -> DataFrame:
    """``conv_id, n, prev, t1, t2, ...``: the turns after the first ``start`` of each conversation as columns.

    ``prev`` names the node of the turns before; ``before`` has it for the conversations that go on.
    """
    part = turns.filter((F.col("pos") > start) & (F.col("pos") <= start + width))
    listed = F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("s")  # at most ``width`` turns
    rows = part.groupBy("conv_id", "n").agg(listed)
    named = [F.get("s", F.lit(i))["id"].alias(c) for i, c in enumerate(_columns(width))]
    if before is None:
        return rows.select("conv_id", "n", F.unhex(F.lit(ROOT)).alias("prev"), *named)
    return rows.join(before, "conv_id").select("conv_id", "n", "prev", *named)


def _name(width: int, below: Column | None = None) -> Column:
    """128-bit name of the node that ``prev`` and the turn columns spell, or only those before column number ``below``."""
    parts = []
    for i, column in enumerate(_columns(width), 1):
        turn = F.col(column) if below is None else F.when(F.lit(i) < below, F.col(column))
        parts.append(F.coalesce(turn, _empty()))
    return F.unhex(F.md5(F.concat("prev", *parts)))


def _rolled(rows: DataFrame, width: int, *sums: Column) -> DataFrame:
    """All prefixes of ``prev, t1, t2, ...`` at once, with ``level``, the number of turn columns in each.

    A conversation that ends inside the block has null columns after its end; a prefix whose last
    column is such a null is no node. grouping_id tells it from a column that was rolled up.
    """
    columns = _columns(width)
    rolled = rows.rollup("prev", *columns).agg(F.grouping_id().alias("set"), *sums)
    level = (F.lit(width) - F.bit_count("set")).cast("int")
    filled = F.size(F.array_compact(F.array(*columns)))
    return rolled.withColumn("level", level).filter((F.col("level") >= 0) & (filled == F.col("level"))).drop("set")


def block_nodes(rows: DataFrame, start: int, width: int) -> DataFrame:
    """The nodes of a block: ``prev, t1, ..., level, conv_id, n_convs, longest, size``; ``longest`` is the number of
    turns of the longest member, ``size`` the bytes of the last text."""
    sums = (F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n").alias("longest"))
    nodes = _rolled(rows, width, *sums).filter("level > 0")
    last = F.get(F.array(*_columns(width)), F.col("level") - 1)
    return nodes.withColumn("size", text_bytes(last)).withColumn("depth", F.col("level") + start)


def subtree_sums(nodes: DataFrame, carried: DataFrame | None, start: int, width: int) -> DataFrame:
    """``name, parent, depth, conv_id, n_convs, n_leaves, saved, tail`` of a block's nodes, and level 0 with the sums below
    each node that the block continues.

    A second ROLLUP adds up what nodes have of their own. ``carried`` has the sums of the next block by its
    ``prev``, which is a node of the last column here. The smallest member, the number of members and
    the longest one are the node's own: no node below exceeds them. ``tail`` marks nodes whose only member goes on past the block.
    """
    alone = (F.col("level") == width) & (F.col("n_convs") == 1) & (F.col("longest") > F.col("depth"))
    ends = F.col("longest") == F.col("depth")
    own = nodes.withColumn("leaves", F.when(ends | alone, 1).otherwise(0).cast("bigint"))
    own = own.withColumn("saved", (F.col("n_convs") - 1) * F.col("size"))
    if carried is not None:
        deepest = own.filter(F.col("level") == width).withColumn("name", _name(width)).join(carried, "name", "left")
        for c in ("leaves", "saved"):
            deepest = deepest.withColumn(c, F.col(c) + F.coalesce(f"more_{c}", F.lit(0)))
        own = own.filter(F.col("level") < width).unionByName(deepest.select(*own.columns))
    sums = (
        F.min("conv_id").alias("conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.max("longest").alias("longest"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
    )
    rolled = _rolled(own, width, *sums).withColumn("depth", F.col("level") + start)
    parent = F.when(F.col("level") == 1, F.col("prev")).otherwise(_name(width, F.col("level")))
    return rolled.select(
        F.when(F.col("level") == 0, F.col("prev")).otherwise(_name(width)).alias("name"),
        parent.alias("parent"),
        "level",
        F.col("depth").cast("bigint").alias("depth"),
        "conv_id",
        "n_convs",
        "n_leaves",
        "saved",
        alone.alias("tail"),
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """``name, ends_sha256`` of rows ``name, conv_id``: the hash of a node's ids in order, joined by commas.

    Ids are joined in runs of at most 4096 first; then each task reads the runs of its nodes in order and
    hashes them as they come, so a node where a third of all conversations end is never held.
    """
    run = ends.groupBy("name", F.shiftright("conv_id", END_BITS).alias("run")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    runs = run.select("name", "run", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(names: list[bytes], hashes: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["name", "ends_sha256"])

        current, state = None, hashlib.sha256()
        for batch in batches:
            names, hashes = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name == current:
                    state.update(b",")
                else:
                    if current is not None:
                        names.append(current)
                        hashes.append(state.hexdigest())
                    current, state = name, hashlib.sha256()
                state.update(ids.encode())
            if names:
                yield made(names, hashes)
        if current is not None:
            yield made([current], [state.hexdigest()])

    dealt = runs.repartition("name").sortWithinPartitions("name", "run").select("name", "ids")
    return dealt.mapInArrow(digests, "name binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A block's turns are columns; one ROLLUP over them counts all its prefixes. Conversations that share the
    block's last node go on in the next block, keyed by it. One that is alone there needs no counting: its
    further nodes have one member each and come straight from its turns. So there are as many blocks as the longest
    beginning that two conversations share takes, however long they are. Sums over subtrees go the other way, from the last block.

    Turns and nodes are told apart by 128-bit hashes. A null role or text is the empty text; a null ``conv_id`` is no conversation;
    turns of equal number, and those without one, follow the hash of role and text; repeated rows are turns of their own;
    extra columns are ignored; no conversations give no rows.
    """
    found, turns = rebuilt(numbered_turns(conversations))
    blocks: list[tuple[DataFrame, int, int]] = []
    ends = [found.filter("n = 0").select(F.unhex(F.lit(ROOT)).alias("name"), "conv_id")]
    tails: list[DataFrame] = []
    before, start = None, 0
    for width in chain(widths, repeat(widths[-1])):
        rows = stored(block_rows(turns, before, start, width), "trie-block")
        nodes = stored(block_nodes(rows, start, width), "trie-nodes")
        blocks.append((nodes, start, width))
        named = rows.withColumn("name", _name(width))
        start += width
        ends.append(named.filter(F.col("n") <= start).select("name", "conv_id"))
        last = nodes.filter((F.col("level") == width) & (F.col("longest") > start))
        tails.append(last.filter("n_convs = 1").select("conv_id", F.lit(start).alias("from")))
        common = stored(last.filter("n_convs > 1").select(_name(width).alias("name")), "trie-common")
        if common.isEmpty():
            break
        going = named.filter(F.col("n") > start).join(common, "name", "left_semi")
        before = going.select("conv_id", F.col("name").alias("prev"))

    parts, carried = [], None
    for nodes, start, width in reversed(blocks):
        sums = stored(subtree_sums(nodes, carried, start, width), "trie-sums")
        parts.append(sums.filter("level > 0"))
        top = sums.filter("level = 0")
        carried = top.select("name", F.col("n_leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    top = top.select("n_leaves", "saved")
    root = found.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.join(F.broadcast(top), F.lit(True), "left").select(
        F.unhex(F.lit(ROOT)).alias("name"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("bigint").alias("depth"),
        "conv_id",
        "n_convs",
        F.coalesce("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("bigint")).alias("saved"),
        F.lit(False).alias("tail"),
    )
    nodes = root
    for part in parts:
        nodes = nodes.unionByName(part.drop("level"))
    nodes = stored(nodes, "trie")

    lists = ends[0]
    for part in ends[1:]:
        lists = lists.unionByName(part)
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("below"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(children, "name", "left").join(ends_digests(lists), "name", "left").join(parents, "parent", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    shared = whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        (F.coalesce("below", F.lit(0).cast("bigint")) + F.col("tail").cast("bigint")).alias("n_children"),
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    single = tails[0]
    for part in tails[1:]:
        single = single.unionByName(part)
    after = turns.join(single, "conv_id").filter(F.col("pos") > F.col("from"))
    at_end = F.col("pos") == F.col("n")
    alone = after.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"),
        F.when(at_end, 0).otherwise(1).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(at_end, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(nothing)).alias("ends_sha256"),
    )
    return shared.unionByName(alone).select(*NODE)


# The same in SQL: nodes are lists of turns, and each node's own part is added to all its beginnings.
SQL = r"""WITH tab AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i))),
o AS (
  SELECT conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    strlen(coalesce(text, '')) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, len, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 9 AS h
  FROM (SELECT conv_id, count(*) AS len FROM o GROUP BY conv_id), tab),
r AS (
  SELECT c.conv_id, o.pos, o.id, o.size FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.len, 0)) + o.pos - c.h, o.id, o.size
  FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h LEFT JOIN c b ON b.conv_id = c.base),
s AS (
  SELECT c.conv_id, coalesce(list(id ORDER BY pos) FILTER (id IS NOT NULL), []) AS ids,
    coalesce(list(size ORDER BY pos) FILTER (id IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d, ids[1:d] AS node, len(ids) = d AS at_end, coalesce(sizes[d], 0) AS size
  FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM s)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '') AS ends FROM m GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.node = n.node),
t AS (
  SELECT node[1:e] AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM f) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, t.n_leaves, t.saved_tokens,
  sha256(f.ends) AS ends_sha256
FROM f JOIN t ON t.node = f.node LEFT JOIN n p ON f.d > 0 AND p.node = f.node[1:f.d - 1]"""
