"""Word n-grams of blocks of texts: what is shuffled is each block's distinct terms, compressed, and how many texts have each of them.

A block holds about ``WORDS`` words of whole texts. Its terms go to buckets, which add up their texts over all blocks and name the blocks that common terms came
from, and where they stood there; the block then works out its terms anew. Buckets are hashes of terms, and terms are told apart by their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.session import stored

WORDS = 1 << 18
BUCKET_TERMS = 1 << 20  # of all blocks together, about
BATCH_ROWS = 50_000  # of one batch that leaves Python
FILE_BLOCKS = 8

_ZSTD = "zstd"


def _press(values: np.ndarray) -> bytes:
    """Numbers that are not negative, byte by byte; :func:`_opened` gives them back."""
    size = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :size].T)
    head = np.array([size, len(values)], dtype=np.int64).tobytes()
    return head + pa.compress(planes.tobytes(), codec=_ZSTD, asbytes=True)


def _opened(data: bytes) -> np.ndarray:
    size, n = np.frombuffer(data[:16], np.int64)
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        out[:, :size] = np.frombuffer(pa.decompress(data[16:], size * n, codec=_ZSTD, asbytes=True), np.uint8).reshape(size, n).T
    return out.view(np.int64).ravel()


def _pressed_text(words: pa.StringArray) -> tuple[bytes, bytes]:
    if not len(words):
        return _press(np.zeros(0, dtype=np.int64)), bytes(8)
    _, places, text = words.buffers()
    offsets = np.frombuffer(places, np.int32)[words.offset : words.offset + len(words) + 1]
    data = text.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return _press(np.diff(offsets)), np.int64(data.size).tobytes() + pa.compress(data, codec=_ZSTD, asbytes=True)


def _opened_text(sizes: bytes, data: bytes) -> pa.StringArray:
    lengths = _opened(sizes)
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    length = int(np.frombuffer(data[:8], np.int64)[0])
    text = pa.decompress(data[8:], length, codec=_ZSTD) if length else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), text)


def blocks(texts: DataFrame, key: str, words: Column) -> DataFrame:
    """Stored blocks ``keys, sizes, codes, lengths, words, block, rows, total`` of the ``words`` of each text; texts of one key share a block."""
    kind = texts.schema[key].dataType.simpleString()
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def row(keys: list, sizes: list[int], pieces: list[pa.Array], kind_: pa.DataType) -> pa.RecordBatch:
        coded = pa.concat_arrays(pieces).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[coded.indices.to_numpy()]
        lengths, text = _pressed_text(coded.dictionary.take(pa.array(order)))
        lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, kind_))
        values = [_press(np.array(sizes, dtype=np.int64)), _press(codes), lengths, text]
        columns = [lists, *(pa.array([v], pa.binary()) for v in values), pa.array([len(keys)], pa.int64()), pa.array([len(codes)], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["keys", "sizes", "codes", "lengths", "words", "rows", "total"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, pieces, held, kind_ = [], [], [], 0, pa.null()
        for batch in batches:
            lists, kind_ = batch.column(1), batch.column(0).type
            offsets, values, begin = lists.offsets.to_numpy(), lists.values, 0
            for i, (name, size) in enumerate(zip(batch.column(0).to_pylist(), np.diff(offsets).tolist(), strict=True)):
                if held >= WORDS and name != keys[-1]:
                    pieces.append(values.slice(offsets[begin], offsets[i] - offsets[begin]))
                    yield row(keys, sizes, pieces, kind_)
                    keys, sizes, pieces, held, begin = [], [], [], 0, i
                keys.append(name)
                sizes.append(size)
                held += size
            pieces.append(values.slice(offsets[begin], offsets[-1] - offsets[begin]))
        if keys:
            yield row(keys, sizes, pieces, kind_)

    dealt = texts.select(key, F.coalesce(words, F.array().cast("array<string>")).alias("words")).repartition(parts, key).sortWithinPartitions(key)
    schema = f"keys array<{kind}>, sizes binary, codes binary, lengths binary, words binary, rows bigint, total bigint"
    return stored(dealt.mapInArrow(cut, schema).withColumn("block", F.monotonically_increasing_id()), FILE_BLOCKS)


class Terms:
    """The distinct terms of a block in order of bucket, ``text`` and ``buckets``, and ``doc, term, tf`` of its texts, numbered as ``keys`` are."""

    def __init__(self, block: dict, low: int, high: int, buckets: int) -> None:
        codes, sizes, words = _opened(block["codes"]), _opened(block["sizes"]), _opened_text(block["lengths"], block["words"])
        keys = block["keys"]
        same = np.array([False, *(a == b for a, b in zip(keys, keys[1:]))])
        place = np.cumsum(~same) - 1
        self.keys = [k for k, s in zip(keys, same) if not s]
        rows = np.repeat(np.arange(len(sizes)), sizes)
        docs = place[rows] if len(rows) else rows
        hashes = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words.to_pylist()], dtype=np.uint64)
        at, level, found, count = np.arange(len(codes)), codes, [], 0
        for n in range(1, high + 1):
            if n > 1:
                inside = at + n - 1 < len(codes)
                at, rank = at[inside], rank[inside]
                inside = rows[at] == rows[at + n - 1]
                at, rank = at[inside], rank[inside]
                level = rank * len(words) + codes[at + n - 1]
            _, first, rank = np.unique(level, return_index=True, return_inverse=True)
            if n >= low:
                entry, tf = np.unique(docs[at] * len(first) + rank, return_counts=True)
                start, h = at[first], np.full(len(first), n, dtype=np.uint64)
                for j in range(n):
                    h = (h ^ hashes[codes[start + j]]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                parts = [words.take(pa.array(codes[start + j])) for j in range(n)]
                text = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")
                found.append((text, h, entry // max(1, len(first)), entry % max(1, len(first)) + count, tf))
                count += len(first)
        text, h, doc, term, tf = zip(*found, strict=True)
        bucket = (np.concatenate(h) >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        self.text, self.buckets = pa.concat_arrays(text).take(pa.array(order)), bucket[order].astype(np.int64)
        number = np.empty(count, dtype=np.int64)
        number[order] = np.arange(count)
        self.doc, self.term, self.tf = np.concatenate(doc), number[np.concatenate(term)], np.concatenate(tf)


def _common(table: pa.Table) -> pa.Table:
    """The terms of a bucket that two or more texts have, how many do, and the blocks and places they came from."""
    sent = table.to_pylist()
    words = [_opened_text(r["lengths"], r["text"]) for r in sent]
    sizes = list(map(len, words))
    coded = pa.concat_arrays(words).dictionary_encode()
    codes = coded.indices.to_numpy()
    totals = np.bincount(codes, np.concatenate([_opened(r["texts"]) for r in sent])).astype(np.int64)
    kept = np.flatnonzero(totals[codes] > 1)
    kept = kept[np.argsort(codes[kept], kind="stable")]
    terms, uses = np.unique(codes[kept], return_counts=True)
    offsets = pa.array(np.cumsum([0, *uses]), pa.int32())
    blocks_of = np.repeat(np.array([r["block"] for r in sent]), sizes)[kept]
    places = np.concatenate([r["first"] + np.arange(n) for r, n in zip(sent, sizes, strict=True)])[kept]
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((blocks_of, pa.int64()), (places, pa.int32()))]
    columns = [coded.dictionary.take(pa.array(terms)), pa.array(totals[terms]), *lists]
    whole = pa.RecordBatch.from_arrays(columns, names=["term", "df", "blocks", "places"])
    return pa.Table.from_batches([whole.slice(at, BATCH_ROWS) for at in range(0, max(1, whole.num_rows), BATCH_ROWS)])


def common(made: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """``(term, df, blocks, places)`` of the terms that two or more texts of the :func:`blocks` have."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"bucket": pa.int32(), "block": pa.int64(), "first": pa.int32(), "lengths": pa.binary(), "text": pa.binary(), "texts": pa.binary()}
        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.slice(at, 1).to_pylist()[0]
                terms = Terms(block, low, high, buckets)
                counts = np.bincount(terms.term, minlength=len(terms.text))
                starts = np.flatnonzero(np.diff(terms.buckets, prepend=-1)).tolist()
                rows = [
                    (int(terms.buckets[a]), block["block"], a, *_pressed_text(terms.text.slice(a, b - a)), _press(counts[a:b]))
                    for a, b in zip(starts, [*starts[1:], len(counts)])
                ]
                if rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

    sent = made.mapInArrow(send, "bucket int, block bigint, first int, lengths binary, text binary, texts binary")
    return sent.groupBy("bucket").applyInArrow(_common, "term string, df bigint, blocks array<bigint>, places array<int>")


def weigh(made: DataFrame, known: DataFrame, key: str, low: int, high: int, buckets: int, total: int) -> DataFrame:
    """``(key, term, weight)`` of the terms of the :func:`blocks`, ``total`` texts; ``known`` are the :func:`common` ones, all others are in one text."""

    def weighed(block: pa.Table, found: pa.Table) -> pa.Table:
        terms = Terms(block.to_pylist()[0], low, high, buckets)
        df = np.ones(len(terms.text))
        df[found["place"].to_numpy()] = found["df"].to_numpy()
        raw = terms.tf * (np.log((total + 1) / (df + 1)) + 1)[terms.term]
        norm = np.sqrt(np.bincount(terms.doc, raw * raw, len(terms.keys)))
        weight, names = raw / norm[terms.doc], pa.array(terms.keys, block["keys"].type.value_type)
        batches = []
        for begin in range(0, max(1, len(weight)), BATCH_ROWS):
            part = slice(begin, begin + BATCH_ROWS)
            columns = [names.take(pa.array(terms.doc[part])), terms.text.take(pa.array(terms.term[part])), pa.array(weight[part])]
            batches.append(pa.RecordBatch.from_arrays(columns, names=[key, "term", "weight"]))
        return pa.Table.from_batches(batches)

    kind = made.schema["keys"].dataType.elementType.simpleString()
    whole = made.select("block", "keys", "sizes", "codes", "lengths", "words")
    told = known.select("df", F.explode(F.arrays_zip("blocks", "places")).alias("p")).select("p.blocks", F.col("p.places").alias("place"), "df")
    return whole.groupBy("block").cogroup(told.groupBy("blocks")).applyInArrow(weighed, f"{key} {kind}, term string, weight double")


def sizes(made: DataFrame, low: int, high: int, bucket_terms: int = BUCKET_TERMS) -> tuple[int, int]:
    """How many texts the :func:`blocks` have, and how many buckets their terms shall have."""
    rows, total = made.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    return rows, max(1, -(-total * (high - low + 1) // bucket_terms))
