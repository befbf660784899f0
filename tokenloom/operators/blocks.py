"""Texts as blocks of word codes, so that a vocabulary meets the distinct words of a block and not every token.

A block holds at most ``TOKENS`` tokens of texts, or of parts of longer ones. Its words are listed once, each token is a number in that list, and
joins and shuffles move a row per block and word. No word has more than one row per block, so no key is hot.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.operators.order import dense_index, exclusive_sum
from tokenloom.session import materialize, stored

TOKENS = 1 << 18
FILE_BLOCKS = 8  # blocks of one file; each is some 3 MB
SCHEMA = (
    "docs array<bigint>, ats array<bigint>, sizes array<int>, totals array<bigint>, codes array<int>, "
    "tokens array<string>, pieces array<int>, insides array<int>, counts array<int>"
)
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _numbered() -> defaultdict[str, int]:
    """Numbers new words 0, 1, 2, ... It doesn't refer to itself: a worker would keep the words of all its blocks until Python looks for cycles."""
    return defaultdict(count().__next__)


def _row(rows: list[tuple[int, int, int, int]], known: dict[str, int], codes: list[int]) -> pa.RecordBatch:
    docs, ats, sizes, totals = zip(*rows)
    coded, ends = np.array(codes, dtype=np.int32), np.cumsum(sizes)
    first = np.empty(len(known), dtype=np.int64)
    first[coded[::-1]] = np.arange(len(coded) - 1, -1, -1)
    piece = np.searchsorted(ends, first, side="right")
    inside = first - (ends - sizes)[piece] if len(first) else first
    values = (docs, ats, sizes, totals, coded, list(known), piece, inside, np.bincount(coded, minlength=len(known)))
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t)) for v, t in zip(values, _TYPES)]
    return pa.RecordBatch.from_arrays(lists, names=_NAMES)


def word_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", tokens: int = TOKENS) -> DataFrame:
    """Stored blocks of the whitespace tokens of all texts, in order of ``key`` inside each block.

    ``docs, ats, sizes, totals`` describe the texts or parts in it: key, first position, tokens here, tokens of the whole text.
    ``codes`` are its tokens as indices into ``tokens``, its distinct words in order of first use, which is at ``insides`` of part ``pieces``;
    ``counts`` are their uses. A text without tokens, or null, is a part of size 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pc.sort_indices(batch.column(0))
            rows, known, codes = [], _numbered(), []
            for begin in range(0, batch.num_rows, 500):
                # Texts are put in order some at a time, so a batch is never held twice.
                part = batch.take(order.slice(begin, 500))
                for doc, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    # Parts words where str.isspace holds, as text.SPACE does.
                    words, at = (value or "").split(), 0
                    while True:
                        taken = words[at : at + tokens - len(codes)]
                        rows.append((doc, at, len(taken), len(words)))
                        codes.extend(map(known.__getitem__, taken))
                        at += len(taken)
                        if len(codes) >= tokens:
                            yield _row(rows, known, codes)
                            rows, known, codes = [], _numbered(), []
                        if at >= len(words):
                            break
            if rows:
                yield _row(rows, known, codes)

    made = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, SCHEMA)
    return stored(made.withColumn("block", F.monotonically_increasing_id()), FILE_BLOCKS)


def spans(blocks: DataFrame) -> DataFrame:
    """``(block, spans)``, stored: an array of ``(at, doc_id, pos, gpos, n)`` of the parts of each block, by their place in it."""
    parts = blocks.select("block", F.posexplode(F.arrays_zip("docs", "ats", "sizes", "totals")).alias("at", "p"))
    parts = parts.select("block", "at", F.col("p.docs").alias("doc_id"), F.col("p.ats").alias("pos"), F.col("p.sizes").alias("n"), "p.totals")
    starts = exclusive_sum(parts.filter("pos = 0").select("doc_id", "totals"), "doc_id", "totals", "start").select("doc_id", "start")
    placed = parts.join(starts, "doc_id").withColumn("gpos", F.col("start") + F.col("pos"))
    rows = F.sort_array(F.collect_list(F.struct("at", "doc_id", "pos", "gpos", "n"))).alias("spans")
    return materialize(placed.groupBy("block").agg(rows))


def first_seen(blocks: DataFrame, placed: DataFrame) -> DataFrame:
    """``(token, gpos, n)`` as of ``vocabulary.first_seen``; ``placed`` are the :func:`spans`."""
    met = blocks.select("block", "tokens", "pieces", "insides", "counts").join(placed, "block")
    words = met.select("spans", "pieces", "insides", "counts", F.posexplode("tokens").alias("code", "token"))
    gpos = F.get("spans", F.get("pieces", F.col("code")))["gpos"] + F.get("insides", F.col("code"))
    uses = words.select("token", gpos.alias("gpos"), F.get("counts", F.col("code")).cast("bigint").alias("n"))
    return uses.groupBy("token").agg(F.min("gpos").alias("gpos"), F.sum("n").alias("n"))


def vocabulary(blocks: DataFrame, placed: DataFrame, start: int = 0) -> DataFrame:
    """``(token, id, n)`` as of ``vocabulary.build``, stored."""
    ranked = dense_index(materialize(first_seen(blocks, placed)), "gpos", key_bits=48)
    return materialize(ranked.select("token", (F.col("index") + F.lit(start).cast("bigint")).alias("id"), "n"))


def words(blocks: DataFrame) -> DataFrame:
    """``(block, code, token)``: the words of each block."""
    return blocks.select("block", F.posexplode("tokens").alias("code", "token"))


def _told(
    blocks: DataFrame, placed: DataFrame, named: DataFrame, value: str, kind: str, make: Callable[[pa.ChunkedArray, np.ndarray, np.ndarray], pa.Array]
) -> DataFrame:
    """``(doc_id, pos, gpos, n, <value>)`` of the parts: ``named`` gives each ``(block, code)`` its ``value``."""

    def place(coded: pa.Table, block: pa.Table) -> pa.Table:
        coded = coded.sort_by("code")
        codes, parts = block["codes"].chunk(0).values.to_numpy(), block["spans"].chunk(0).values.flatten()
        if coded.num_rows != codes.max(initial=-1) + 1:
            raise ValueError("each word of a block needs one value")
        ends = np.cumsum(parts[4].to_numpy(), dtype=np.int32)
        out = make(coded[value], codes, np.concatenate([np.zeros(1, dtype=np.int32), ends]))
        return pa.table([parts[1], parts[2], parts[3], parts[4], out], names=["doc_id", "pos", "gpos", "n", value])

    whole = blocks.select("block", "codes").join(placed, "block")
    told = named.select(F.col("block").alias("of"), "code", value)
    both = told.groupBy("of").cogroup(whole.groupBy("block"))
    return both.applyInArrow(place, f"doc_id bigint, pos bigint, gpos bigint, n int, {value} {kind}").filter("n > 0")


def encode(blocks: DataFrame, placed: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, pos, gpos, n, ids)``: the ids of each text, or part of a long one, that stand from ``pos`` of it and ``gpos`` of the stream.

    ``vocab`` has every word; the job fails on one that it lacks.
    """

    def arrays(ids: pa.ChunkedArray, codes: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.to_numpy()[codes]))

    named = words(blocks).join(vocab.select("token", "id"), "token").withColumnRenamed("id", "ids")
    return _told(blocks, placed, named, "ids", "array<bigint>", arrays)


def decode(blocks: DataFrame, placed: DataFrame, named: DataFrame) -> DataFrame:
    """``(doc_id, text)``: each text with its words replaced by ``word`` of ``named`` ``(block, code, word)``, an empty one where that is null."""

    def texts(found: pa.ChunkedArray, codes: np.ndarray, ends: np.ndarray) -> pa.Array:
        names = np.array([w or "" for w in found.to_pylist()], dtype=object)[codes]
        return pa.array([" ".join(names[b:e]) for b, e in zip(ends[:-1], ends[1:])], pa.string())

    parts = _told(blocks, placed, named, "word", "string", texts)
    pieces = F.sort_array(F.collect_list(F.struct("pos", "word")))["word"]
    return parts.groupBy("doc_id").agg(F.trim(F.array_join(pieces, " ")).alias("text"))


def sizes(blocks: DataFrame, placed: DataFrame, every: int) -> DataFrame:
    """``(block, tokens, bytes)``: tokens, and bytes they take with a blank each, of every ``every`` tokens of the stream; no row per token is made."""
    lengths = F.transform("tokens", lambda t: (F.octet_length(t) + 1).cast("bigint"))
    told = blocks.select("block", "codes", lengths.alias("_bytes")).join(placed, "block")
    told = told.select("spans", F.transform("codes", lambda c: F.get("_bytes", c)).alias("_bytes"))
    ends = F.aggregate("spans", F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s["n"])))
    parts = told.withColumn("_ends", ends).select("_bytes", "_ends", F.posexplode("spans").alias("_i", "s"))
    parts = parts.select(F.col("s.gpos").alias("gpos"), F.slice("_bytes", F.get("_ends", F.col("_i")) + 1, F.col("s.n")).alias("ids"))
    met = cut(parts, "_number", every, every)
    total = F.aggregate("part", F.lit(0).cast("bigint"), lambda a, b: a + b)
    sums = met.select((F.col("_number") - 1).alias("block"), F.size("part").alias("n"), total.alias("b"))
    return sums.groupBy("block").agg(F.sum("n").alias("tokens"), F.sum("b").alias("bytes"))


def rows(texts: DataFrame) -> DataFrame:
    """``(doc_id, pos, gpos, id)``: a row per token of :func:`encode`, worked out where its text lies."""
    told = texts.select("doc_id", "pos", "gpos", F.posexplode("ids").alias("_at", "id"))
    return told.select("doc_id", (F.col("pos") + F.col("_at")).cast("int").alias("pos"), (F.col("gpos") + F.col("_at")).alias("gpos"), "id")


def cut(texts: DataFrame, number: str, step: int, size: int) -> DataFrame:
    """``(<number>, start, part)``: the ids of ``texts`` in windows of ``size`` that begin every ``step`` tokens, numbered from 1; a row per text and window."""
    gpos, end = F.col("gpos"), F.col("gpos") + F.size("ids")
    low = F.greatest(F.lit(1), F.floor((gpos - size) / step) + 2)
    met = texts.filter(F.size("ids") > 0).select("gpos", "ids", F.explode(F.sequence(low, F.floor((end - 1) / step) + 1)).alias(number))
    first = (F.col(number) - 1) * step
    begin, stop = F.greatest(gpos, first), F.least(end, first + size)
    part = F.slice("ids", (begin - gpos + 1).cast("int"), (stop - begin).cast("int"))
    return met.select(number, begin.alias("start"), part.alias("part"))
