"""Substring dedup by content-defined chunks: a gear hash sets the cuts, digests find repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

LEAST, MASK_BITS, MOST = 24, 5, 256  # bytes of a chunk: at least, 2**bits more on average, at most
MIN_RUN = LEAST + (1 << MASK_BITS)  # bytes of repeated chunks in a row that go: a mean chunk; a whole text always goes
_GEAR = np.random.default_rng(5).integers(0, 2**32, 256, dtype=np.uint32)
_MASK = np.uint32(((1 << MASK_BITS) - 1) << (32 - MASK_BITS))


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a byte array.

    The gear hash of a position adds a random number per byte, doubled with each byte since, so it looks
    at the last 32 bytes only; it is summed for all positions at once by doubling the span five times. A chunk ends where the
    hash's top bits are 0, once it has ``LEAST`` bytes, or at ``MOST``; an insertion moves only the cuts near it.
    """
    n = len(data)
    gear = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        before = np.zeros_like(gear)
        before[step:] = gear[:-step] << np.uint32(step)
        gear = gear + before
    ends, last = [], 0
    for at in (np.flatnonzero((gear & _MASK) == 0) + 1).tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST:
            last = at
            ends.append(at)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """``_doc, _text, start, length, d1, d2``: the chunks of every text and their 128-bit digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                docs_, texts, starts, lengths, digests, counts = part.column(0), part.column(1), [], [], [], []
                for text in part.column(2).to_pylist():
                    data = (text or "").encode()
                    ends = cuts(np.frombuffer(data, dtype=np.uint8))
                    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
                    starts.append(begins)
                    lengths.append(ends - begins)
                    counts.append(len(ends))
                    digests += [
                        hashlib.blake2b(data[a:b], digest_size=16).digest()
                        for a, b in zip(begins.tolist(), ends.tolist(), strict=True)
                    ]
                take = pa.array(np.repeat(np.arange(part.num_rows), counts))
                words = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs_.take(take),
                        texts.take(take),
                        pa.array(np.concatenate([*starts, np.zeros(0, np.int64)]), pa.int64()),
                        pa.array(np.concatenate([*lengths, np.zeros(0, np.int64)]).astype(np.int32), pa.int32()),
                        pa.array(words[:, 0]),
                        pa.array(words[:, 1]),
                    ],
                    names=["_doc", "_text", "start", "length", "d1", "d2"],
                )

    rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), "text")
    return rows.mapInArrow(run, "_doc bigint, _text bigint, start bigint, length int, d1 bigint, d2 bigint")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``_doc, _text, start, end``: chunks that stand earlier too, in order of ``doc_id`` and place.

    Half the digest counts first, with sums in each task, and drops the chunks that stand once; only the rest
    looks for its first place. A frequent chunk is one row per task in both sums.
    """
    rows = chunk_rows(docs)
    twice = rows.groupBy("d1").agg(F.count("*").alias("n")).filter("n > 1").select("d1")
    # Stored sums leave both sides of a join free, so a frequent chunk's rows can be split over tasks.
    some = stored(rows.join(stored(twice, "repeated-chunks"), "d1"), "chunk-places")
    place = F.struct(F.col("_doc").isNull().alias("u"), "_doc", "_text", "start")
    first = stored(some.groupBy("d1", "d2").agg(F.min(place).alias("first")), "first-places")
    later = some.join(first, ["d1", "d2"]).filter(place > F.col("first"))
    return later.select("_doc", "_text", "start", (F.col("start") + F.col("length")).alias("end"))


def without_spans(docs: DataFrame, spans: DataFrame, least: int = 0) -> DataFrame:
    """Cut byte spans out of texts: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) for every row.

    ``spans`` are rows ``_doc, _text, start, end`` of bytes; touching ones are joined first, and joined
    ones under ``least`` bytes stay in the text, unless they are all of it.
    """

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, counts, sizes = [], [], [], []
            for text, starts, ends in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                data = (text or "").encode()
                out, at, cut, number = [], 0, 0, 0
                runs: list[list[int]] = []
                for a, b in sorted(zip(starts or (), ends or (), strict=True)):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                for a, b in runs:
                    if b - a >= least or b - a == len(data):
                        out.append(data[at:a])
                        at, cut, number = b, cut + b - a, number + 1
                out.append(data[at:])
                kept.append(b"".join(out))
                removed.append(cut)
                counts.append(number)
                sizes.append(len(data))
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, counts)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(kept, pa.binary())], names=names)

    lists = spans.groupBy("_doc", "_text").agg(F.collect_list(F.struct("start", "end")).alias("s"))
    lists = lists.select("_doc", "_text", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    joined = named.alias("d").join(lists.alias("s"), F.expr("d.doc_id <=> s._doc AND d._text = s._text"), "left")
    rows = joined.select("d.doc_id", "d.text", "s.starts", "s.ends")
    return rows.mapInArrow(join_spans, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def dedup(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Texts without chunks that stand earlier: ``doc_id, n_bytes, n_removed, n_spans, kept``.

    The first place of a chunk, by ``doc_id`` (null last), text hash and position, stays; later ones go
    if they make up ``min_run`` bytes in a row or the whole text. Null texts count as empty; rows with the same id and text share
    their result; extra columns are ignored.
    """
    return without_spans(docs, repeated_spans(docs), min_run)


def digest(kept: DataFrame) -> DataFrame:
    """``kept_sha256`` in place of the bytes."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
