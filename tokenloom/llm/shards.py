"""Sharding by a k-d tree over metadata: cells are cut at distributed weighted medians of their widest dimension."""

from __future__ import annotations

import os.path
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

SHARDS = 16  # Fixed value: the shards of the query.
DIMENSIONS = ("source", "lang", "size", "doc_id")  # of one width, the first is cut
COORDINATE_BITS, TIE_BITS, PLACE_BITS, DIGIT_BITS = 24, 36, 60, 16
TOP_BITS = 12  # of a coordinate, for the first look at all dimensions
WINDOW_ROWS = 65_536  # a cell's rows around the median that one sort may hold
NAME_CHARS = 64  # code points of a text dimension that count
SIZED = ("doc_id", "size", "text_crc32", "_row")


@dataclass(frozen=True)
class Axis:
    """One metadata dimension, scaled to whole numbers of ``COORDINATE_BITS`` bits over all documents.

    Null has the lowest coordinate. Texts keep their byte order: the six bytes after what all values have
    in common make a number.
    """

    column: str
    lowest: float
    highest: float
    shared: int | None = None  # bytes that all texts begin with; None for a number

    def coordinate(self) -> Column:
        value = F.col(self.column)
        if self.shared is not None:
            digits = F.hex(F.substring(value.cast("binary"), self.shared + 1, 6))
            value = F.conv(F.rpad(digits, 12, "0"), 16, 10)
        if self.highest <= self.lowest:
            return F.lit(0).cast("bigint")
        top = 1 << COORDINATE_BITS
        share = (value.cast("double") - F.lit(self.lowest)) / F.lit(self.highest - self.lowest)
        scaled = F.coalesce(F.floor(share * top).cast("bigint"), F.lit(0).cast("bigint"))
        return F.least(scaled, F.lit(top - 1).cast("bigint"))

    def key(self) -> Column:
        """The coordinate, then a hash of the id: rows that share a coordinate can be parted anywhere."""
        tie = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - TIE_BITS)
        return F.shiftleft(self.coordinate(), TIE_BITS).bitwiseOR(tie)


def place() -> Column:
    """After the key, rows that share an id too follow a hash of their place in the input."""
    return F.shiftrightunsigned(F.xxhash64("_row"), 64 - PLACE_BITS)


def sized_rows(docs: DataFrame, dimensions: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``doc_id, size, text_crc32, _row`` and ``_m0, _m1, ...``: what the tree needs of each document, without texts."""
    text = F.col("text").cast("binary")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")
    columns = [
        F.col("doc_id").cast("bigint").alias("doc_id"),
        size.alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("bigint")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    ]
    names = []
    for name in dimensions:
        if name == "size":  # by its logarithm, or a few long texts would set the scale
            value = F.log2(size)
        elif name not in docs.columns:
            continue
        elif dict(docs.dtypes)[name] == "string":
            value = F.substring(F.col(name), 1, NAME_CHARS)
        else:
            value = F.col(name).cast("double")
        names.append(f"_m{len(names)}")
        columns.append(value.alias(names[-1]))
    return stored(docs.select(*columns), "shard-rows"), names


def axes(rows: DataFrame, names: list[str]) -> list[Axis]:
    """The scales, from one row of extremes."""
    ends = [f(n).alias(f"{n}_{f.__name__}") for n in names for f in (F.min, F.max)]
    found, kinds = rows.agg(*ends).first(), dict(rows.dtypes)
    made = []
    for name in names:
        low, high = found[f"{name}_min"], found[f"{name}_max"]
        if low is None:
            made.append(Axis(name, 0.0, 0.0))
        elif kinds[name] == "string":
            low, high = low.encode(), high.encode()
            shared = len(os.path.commonprefix([low, high]))
            number = lambda b, k=shared: float(int.from_bytes(b[k : k + 6].ljust(6, b"\0"), "big"))
            made.append(Axis(name, number(low), number(high), shared))
        else:
            made.append(Axis(name, low, high))
    return made


def keyed_rows(docs: DataFrame, dimensions: tuple[str, ...]) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, _row``, the order of each dimension as ``_k0, _k1, ...`` and ``_place``."""
    rows, names = sized_rows(docs, dimensions)
    keys = [a.key().alias(f"_k{i}") for i, a in enumerate(axes(rows, names))]
    return stored(rows.select(*SIZED, *keys, place().alias("_place")), "shard-keys"), len(keys)


def _key(dimensions: int) -> Column:
    """The key of the dimension that ``dim`` names; null without one."""
    return F.get(F.array(*[F.col(f"_k{i}") for i in range(dimensions)]), F.col("dim"))


# A row's order in parts of few bits, from the highest: its column, where the part begins and how many bits it has.
PARTS = [("key", COORDINATE_BITS + TIE_BITS - TOP_BITS, TOP_BITS)] + [
    (column, max(at, 0), DIGIT_BITS + min(at, 0))
    for column, bits in (("key", COORDINATE_BITS + TIE_BITS - TOP_BITS), ("_place", PLACE_BITS))
    for at in range(bits - DIGIT_BITS, -DIGIT_BITS, -DIGIT_BITS)
]


def _digit(part: int) -> Column:
    column, at, bits = PARTS[part]
    return F.shiftright(column, at).bitwiseAND((1 << bits) - 1)


def _crossing(parts: DataFrame, group: list[str]) -> DataFrame:
    """Of rows ``(group, digit, w, n, before, target)`` with sums per digit, the one in which each group's sum
    reaches its target, with the sum ``before`` it."""
    order = Window.partitionBy(*group).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("w").over(order), F.lit(0)))
    reached = summed.filter((F.col("before") <= F.col("target")))
    return reached.groupBy(*group, "target").agg(F.max(F.struct("digit", "before", "n")).alias("at"))


def widest(rows: DataFrame, dimensions: int) -> DataFrame:
    """Per cell with several leaves ``shard, leaves, dim, target, before, d0, n``: its widest dimension and the
    part of it, of 4096, that holds the weighted median.

    One pass looks at all dimensions; each task sums first, and a cell has at most 4096 sums a dimension.
    """
    keys = F.array(*[F.col(f"_k{i}") for i in range(dimensions)])
    named = rows.filter("leaves > 1").select("shard", "leaves", "size", F.posexplode(keys).alias("dim", "key"))
    sums = named.groupBy("shard", "leaves", "dim", _digit(0).alias("digit")).agg(
        F.sum("size").alias("w"), F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    sums = stored(sums, "shard-sums")
    width = F.shiftright(F.max("high"), TIE_BITS) - F.shiftright(F.min("low"), TIE_BITS)
    spans = sums.groupBy("shard", "leaves", "dim").agg(width.alias("width"), F.sum("w").alias("total"))
    best = spans.groupBy("shard", "leaves").agg(F.max_by(F.struct("dim", "total"), F.struct("width", -F.col("dim"))).alias("b"))
    share = F.floor(F.col("leaves") / 2) / F.col("leaves")
    chosen = best.select("shard", F.col("b.dim").alias("dim"), (F.col("b.total") * share).alias("target"))
    parts = sums.join(chosen, ["shard", "dim"]).withColumn("before", F.lit(0).cast("bigint"))
    found = _crossing(parts, ["shard", "leaves", "dim"])
    return found.select("shard", "leaves", "dim", "target", "at.before", F.col("at.digit").alias("d0"), "at.n")


def _around(rows: DataFrame, cells: DataFrame, dimensions: int, known: int) -> DataFrame:
    """Rows that share the first ``known`` parts of their order with their cell's median, with ``key``."""
    near = rows.join(F.broadcast(cells), ["shard", "leaves"]).withColumn("key", _key(dimensions))
    for i in range(known):
        near = near.filter(_digit(i) == F.col(f"d{i}"))
    return near


def medians(rows: DataFrame, dimensions: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``shard, leaves, dim, cut_key, cut_place`` per cell with several leaves: where it is cut.

    Rows up to the cut, by key and place, weigh as near to the left leaves' share as single rows allow. Digit
    by digit, sums close in on the median; once it lies among few rows, these are sorted.
    """
    cells, known = stored(widest(rows, dimensions), "shard-cells"), 1
    while known < len(PARTS) and (cells.agg(F.max("n")).first()[0] or 0) > window_rows:
        near = _around(rows, cells, dimensions, known)
        past = [f"d{i}" for i in range(known)]
        group = ["shard", "leaves", "dim", *past]
        sums = near.groupBy(*group, "target", "before", _digit(known).alias("digit")).agg(
            F.sum("size").alias("w"), F.count("*").alias("n")
        )
        at = _crossing(sums, group)
        cells = at.select(*group, "target", "at.before", F.col("at.digit").alias(f"d{known}"), "at.n")
        cells, known = stored(cells, "shard-cells"), known + 1
    near = _around(rows, cells, dimensions, known).withColumn("place", F.col("_place"))
    order = Window.partitionBy("shard").orderBy("key", "place").rowsBetween(Window.unboundedPreceding, 0)
    off = F.abs(F.col("before") + F.sum("size").over(order) - F.col("target"))
    ends = near.select("shard", "leaves", "dim", "key", "place", off.alias("off"), F.abs(F.col("before") - F.col("target")).alias("none"))
    best = ends.groupBy("shard", "leaves", "dim").agg(
        F.min(F.struct("off", "key", "place")).alias("best"),
        F.min(F.struct("key", "place")).alias("first"),
        F.min("none").alias("none"),
    )
    all_right = F.col("none") <= F.col("best.off")  # the cut lies before all of these rows
    return best.select(
        "shard",
        "leaves",
        "dim",
        F.when(all_right, F.col("first.key")).otherwise(F.col("best.key")).alias("cut_key"),
        F.when(all_right, F.col("first.place") - 1).otherwise(F.col("best.place")).alias("cut_place"),
    )


def slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: the rows of each ``shard`` counted from 0 in the order of ``_row``.

    Blocks of 65,536 places are counted, the counts summed up in two steps, and the rows numbered inside their block.
    """
    cut = rows.withColumn("_block", F.shiftright("_row", 16))
    counts = stored(cut.groupBy("shard", "_block").agg(F.count("*").alias("n")), "shard-blocks")
    counts = counts.withColumn("_high", F.shiftright("_block", 24))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    low, high = before.partitionBy("shard", "_high").orderBy("_block"), before.partitionBy("shard").orderBy("_high")
    highs = counts.groupBy("shard", "_high").agg(F.sum("n").alias("n"))
    highs = highs.select("shard", "_high", F.coalesce(F.sum("n").over(high), F.lit(0)).alias("_far"))
    starts = counts.withColumn("_near", F.coalesce(F.sum("n").over(low), F.lit(0))).join(highs, ["shard", "_high"])
    starts = starts.select("shard", "_block", (F.col("_near") + F.col("_far")).alias("_start"))
    inside = Window.partitionBy("shard", "_block").orderBy("_row")
    numbered = cut.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "_block"]).withColumn("slot", (F.col("_start") + F.col("_at")).cast("bigint"))


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = DIMENSIONS,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes and 1, ``slot`` the row's place in its shard. Give the number of shards, or the bytes a
    shard should reach. A cell for k shards is cut where floor(k/2)/k of its bytes lie on the left, along
    the dimension in which it is widest; so every shard gets an equal part of all bytes, up to a
    few rows, and holds documents with like metadata. A value that a third of all rows share is cut inside, by a
    hash of the id and then of the row's place, so repeated rows and ids are spread too.

    A null text has size 1 and CRC 0. Null metadata comes first; a dimension that ``docs`` lacks doesn't count;
    extra columns are ignored. With fewer rows than shards some shards are empty; no documents give no rows. The
    same files read in the same splits give the same shards, and unique ids do in any splits; slots follow the splits.
    """
    rows, width = keyed_rows(docs, dimensions)
    if shards is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(1, -(-total // target_bytes)) if target_bytes else SHARDS
    cells = rows.select("*", F.lit(0).cast("bigint").alias("shard"), F.lit(shards).cast("bigint").alias("leaves"))
    for _ in range((shards - 1).bit_length()):
        cuts = stored(medians(cells, width, window_rows), "shard-cuts")  # a row for each cell, fewer than shards
        met = cells.join(F.broadcast(cuts), ["shard", "leaves"], "left")
        met = met.withColumn("_key", _key(width))
        right = (F.col("_key") > F.col("cut_key")) | ((F.col("_key") == F.col("cut_key")) & (F.col("_place") > F.col("cut_place")))
        left = F.floor(F.col("leaves") / 2)
        split = F.col("dim").isNotNull()
        cells = met.select(
            *rows.columns,
            F.when(split & right, F.col("shard") + left).otherwise(F.col("shard")).alias("shard"),
            F.when(split & right, F.col("leaves") - left).when(split, left).otherwise(F.col("leaves")).alias("leaves"),
        )
    placed = slots(stored(cells.select(*SIZED, "shard"), "sharded"))
    return placed.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")


def digest(placed: DataFrame) -> DataFrame:
    """The law that the shards follow: equal bytes. A changed number of shards moves rows between all of them."""
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
