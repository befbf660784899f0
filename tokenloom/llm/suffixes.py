"""Removal of long repeated byte strings by a distributed, common-prefix-aware sort of suffixes.

Two equal strings of ``SPAN`` bytes have the same anchor: the place of their least 16-byte hash among the first
``REACH`` bytes. So it is enough to sort the suffixes that begin at anchors, and of those the ones
whose first ``SPAN - REACH + 1`` bytes stand at another anchor too. Tasks sort
runs of suffixes, exchange them front-coded by ranges, and merge the runs of a range with a loser
tree that never looks at a known common prefix again. In sorted order, common prefixes to
the right and equal bytes to the left of the anchors tell exactly which strings repeat.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.chunks import without_spans
from tokenloom.llm.common import stored
from tokenloom.llm.shingles import mix

SPAN = 400  # Fixed value: bytes of a repeated string.
REACH = 192  # starts among which a string's anchor is chosen
GRAM = 16  # bytes an anchor's hash looks at
CORE = SPAN - REACH + 1  # bytes from the anchor that all its strings hold
RUN_ITEMS, PART_ITEMS = 40_000, 40_000  # suffixes of a sorted run, and on average of a merged range
SAMPLES = 16  # sampled suffixes per range, from which the ranges are cut
_RANDOM = np.random.default_rng(3)
_TABLES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    """Powers of a base or of its inverse modulo 2**64, kept for the next text."""
    known = _POWERS.get((which, inverse))
    if known is None or len(known) < n:
        base = int(_BASES[which])
        base = pow(base, -1, 1 << 64) if inverse else base
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _POWERS[which, inverse] = known
    return known[:n]


def anchors(data: np.ndarray) -> np.ndarray:
    """Anchors of all strings of ``SPAN`` bytes, in order."""
    n = len(data)
    if n < SPAN:
        return np.zeros(0, dtype=np.int64)
    gram, step = _TABLES[0][data], 1
    while step < GRAM:
        gram = gram[:-step] * np.uint64(pow(int(_BASES[0]), step, 1 << 64)) + gram[step:]
        step *= 2
    order = (gram[: n - SPAN + REACH] * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    least = (order << np.uint64(32)) | np.arange(len(order), dtype=np.uint64)
    have = 1
    while have < REACH:
        step = min(have, REACH - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLES[which][data] * _powers(which, True, len(data)), out=sums[1:], dtype=np.uint64)
    return mix((sums[ends] - sums[starts]) * _powers(which, False, len(data) + 1)[starts])


def anchor_rows(docs: DataFrame) -> DataFrame:
    """``_doc, _text, at, left, right, core, item1, item2`` of every anchor.

    ``left`` and ``right`` bytes around it are those its strings can hold; ``core`` is a hash of
    the ``CORE`` bytes from it, ``item1, item2`` a 128-bit hash of all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                columns: list[list[np.ndarray]] = [[] for _ in range(6)]
                counts = []
                for text in part.column(2).to_pylist():
                    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
                    at = anchors(data)
                    counts.append(len(at))
                    if not len(at):
                        continue
                    left, right = np.minimum(at, REACH - 1), np.minimum(len(data) - at, SPAN)
                    core = _range_hashes(data, at, at + CORE, 0)
                    shape = mix((left * (SPAN + 1) + right).astype(np.uint64))
                    items = [_range_hashes(data, at - left, at + right, i) ^ shape for i in (0, 1)]
                    for column, values in zip(columns, (at, left, right, core, *items), strict=True):
                        column.append(values)
                take = pa.array(np.repeat(np.arange(part.num_rows), counts))
                kinds = (np.int32, np.int16, np.int16, np.int64, np.int64, np.int64)
                arrays = []
                for column, kind in zip(columns, kinds, strict=True):
                    values = np.concatenate(column) if column else np.zeros(0, kind)
                    arrays.append(pa.array(values.astype(kind)))  # wraps unsigned hashes
                names = ["_doc", "_text", "at", "left", "right", "core", "item1", "item2"]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *arrays], names=names)

    rows = docs.filter(F.octet_length("text") >= SPAN)
    rows = rows.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"), "text")
    return rows.mapInArrow(
        run, "_doc bigint, _text bigint, at int, left smallint, right smallint, core bigint, item1 bigint, item2 bigint"
    )


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    while known < end:
        x, y = a[known : known + 64], b[known : known + 64]
        if x == y:
            known += len(x)
            continue
        size = min(len(x), len(y))
        differ = int.from_bytes(x[:size]) ^ int.from_bytes(y[:size])
        return known + size - (differ.bit_length() + 7) // 8
    return min(known, end)


def front_code(keys: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Common prefix with the key before, and what follows it, of sorted keys."""
    common = np.zeros(len(keys), dtype="<u2")
    for i in range(1, len(keys)):
        common[i] = _common(keys[i - 1], keys[i], 0)
    return common, b"".join(k[c:] for k, c in zip(keys, common.tolist(), strict=True))


def front_decode(common: np.ndarray, lengths: np.ndarray, rest: bytes) -> list[bytes]:
    """The keys again."""
    out, at, last = [], 0, b""
    for c, n in zip(common.tolist(), lengths.tolist(), strict=True):
        last = last[:c] + rest[at : at + n - c]
        at += n - c
        out.append(last)
    return out


class LoserTree:
    """Merges sorted, front-coded runs.

    Every head of a run knows its common prefix with the key put out last. The longer one is the smaller
    head; only heads with equal prefixes are compared, from that prefix on, and the loser keeps the
    prefix it then has in common with the winner. So no byte is compared twice on the way.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]) -> None:
        self.runs, self.at = runs, [0] * len(runs)
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.common = [0] * self.size  # common prefix of a head with the last key out
        self.heads: list[bytes | None] = [r[0][0] if r[0] else None for r in runs]
        self.heads += [None] * (self.size - len(runs))
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, loser = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = loser
        return winner

    def _play(self, one: int, two: int) -> tuple[int, int]:
        a, b = self.heads[one], self.heads[two]
        if a is None or b is None:
            return (two, one) if a is None else (one, two)
        x, y = self.common[one], self.common[two]
        if x != y:
            return (one, two) if x > y else (two, one)
        same = _common(a, b, x)
        first = a[same:] <= b[same:]
        winner, loser = (one, two) if first else (two, one)
        self.common[loser] = same
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """``(run, index, common prefix with the key before)`` in sorted order."""
        while (run := self.winner) < len(self.runs) and self.heads[run] is not None:
            keys, prefixes = self.runs[run]
            index = self.at[run]
            yield run, index, self.common[run]
            index += 1
            self.at[run] = index
            if index < len(keys):
                # The run's own front coding is the prefix shared with the key just put out.
                self.heads[run], self.common[run] = keys[index], prefixes[index]
            else:
                self.heads[run] = None
            node, winner = (run + self.size) // 2, run
            while node >= 1:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


_RUN_SCHEMA = "n int, common binary, lengths binary, rest binary, lefts binary, left_lengths binary, places binary"


def _packed(items: list[tuple[bytes, bytes, int, int, int]], extra: tuple = ()) -> tuple:
    """A sorted run of ``(key, left bytes, doc, text, at)`` as one row."""
    common, rest = front_code([i[0] for i in items])
    lengths = np.array([len(i[0]) for i in items], dtype="<u2")
    lefts = np.array([len(i[1]) for i in items], dtype="<u2")
    nulls = [i[2] is None for i in items]
    places = np.array([(int(u), i[2] or 0, i[3], i[4]) for u, i in zip(nulls, items, strict=True)], dtype="<i8")
    left = zlib.compress(b"".join(i[1] for i in items), 1)
    return (*extra, len(items), common.tobytes(), lengths.tobytes(), zlib.compress(rest, 1), left, lefts.tobytes(), places.tobytes())


def _unpacked(row: dict) -> tuple[list[bytes], np.ndarray, list[bytes], np.ndarray]:
    common = np.frombuffer(row["common"], dtype="<u2")
    keys = front_decode(common, np.frombuffer(row["lengths"], dtype="<u2"), zlib.decompress(row["rest"]))
    left, at, lefts = zlib.decompress(row["lefts"]), 0, []
    for n in np.frombuffer(row["left_lengths"], dtype="<u2").tolist():
        lefts.append(left[at : at + n])
        at += n
    return keys, common, lefts, np.frombuffer(row["places"], dtype="<i8").reshape(-1, 4)


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def sorted_runs(texts: DataFrame) -> DataFrame:
    """Sorted, front-coded runs of the suffixes at ``places`` (an array of int) of ``_doc, _text, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[bytes, bytes, int, int, int]] = []
        for batch in batches:
            for doc, text, body, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = body.encode()
                items += [(data[a : a + SPAN], data[max(0, a - REACH + 1) : a], doc, text, a) for a in places]
                while len(items) >= RUN_ITEMS:
                    some, items = items[:RUN_ITEMS], items[RUN_ITEMS:]
                    yield _arrow([_packed(sorted(some, key=lambda i: i[0]))], _RUN_SCHEMA)
        if items:
            yield _arrow([_packed(sorted(items, key=lambda i: i[0]))], _RUN_SCHEMA)

    return texts.select("_doc", "_text", "text", "places").mapInArrow(run, _RUN_SCHEMA)


def splitters(runs: DataFrame, parts: int) -> tuple[list[bytes], set[bytes]]:
    """Least cores of the ranges 1, 2, ..., and the cores that would fill more than one range.

    They come from a sample of about ``SAMPLES`` keys per range. A range begins with a whole core, so equal cores meet
    in one task. A core at which two ranges or more would begin is shared by many suffixes, equal or not, and goes into no range.
    """
    total = runs.agg(F.sum("n")).first()[0] or 0
    every = max(1, total // (SAMPLES * parts))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _unpacked(row)[0]
                # The first place is by the run's own places, so short runs count by their share, equal ones too.
                first = zlib.crc32(row["places"]) % every
                yield _arrow([(k,) for k in keys[first::every]], "key binary")

    if parts == 1:
        return [], set()
    keys = sorted(bytes(r["key"]) for r in runs.mapInArrow(sample, "key binary").collect())
    # Counted before they are made distinct: the sampled keys of a frequent core may all be the same.
    cores = Counter(keys[i * len(keys) // parts][:CORE] for i in range(1, parts)) if keys else Counter()
    return sorted(cores), {c for c, n in cores.items() if n > 1}


def _cut_runs(runs: DataFrame, bounds: list[bytes], shared: set[bytes]) -> DataFrame:
    """The pieces of all runs by range, without the ``shared`` cores: ``part`` and the columns of a run."""
    schema = "part int, " + _RUN_SCHEMA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, _, lefts, places = _unpacked(row)
                edges = [0, *(bisect_left(keys, b) for b in bounds), len(keys)]
                for part, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    items = [
                        (keys[i], lefts[i], None if places[i, 0] else int(places[i, 1]), int(places[i, 2]), int(places[i, 3]))
                        for i in range(a, b)
                        if keys[i][:CORE] not in shared
                    ]
                    if items:
                        yield _arrow([_packed(items, (part,))], schema)

    return runs.mapInArrow(run, schema)


def _hashed_strings(runs: DataFrame, shared: set[bytes]) -> DataFrame:
    """All strings of the suffixes with a ``shared`` core, by hash; they need no order, so they stay in their runs' tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, _, lefts, places = _unpacked(row)
                out: list[tuple] = []
                for i, key in enumerate(keys):
                    if key[:CORE] not in shared:
                        continue
                    unknown, doc, text, at = places[i].tolist()
                    whole, size = lefts[i] + key, len(lefts[i])
                    for d in range(max(0, SPAN - len(key)), size + 1):
                        name = hashlib.blake2b(whole[size - d : size - d + SPAN], digest_size=16).digest()
                        f1, f2 = np.frombuffer(name, dtype="<i8").tolist()
                        out.append((None if unknown else doc, text, at - d, at - d + SPAN, f1, f2))
                    if len(out) > 20_000:
                        yield _arrow(out, _HASHED)
                        out = []
                if out:
                    yield _arrow(out, _HASHED)

    return runs.mapInArrow(run, _HASHED)


def repeats_in_order(prefix: np.ndarray, rights: np.ndarray, lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For sorted suffixes, the least and largest offset d at which the string that begins d bytes
    before the anchor stands at another suffix too; -1 where there is none.

    ``prefix`` is the common prefix with the suffix before. Strings at offset d are equal if no prefix under
    ``SPAN - d`` lies between the two suffixes and their d bytes to the left are equal.
    """
    n = len(prefix)
    low, high = np.full(n, -1), np.full(n, -1)
    left_size = np.array([len(x) for x in lefts])
    table = np.zeros((REACH - 1, n), dtype=np.int64)  # row d - 1: the byte d before the anchor
    for i, x in enumerate(lefts):
        table[: len(x), i] = np.frombuffer(x, dtype=np.uint8)[::-1]
    group = np.cumsum(prefix < CORE)
    for d in range(REACH):
        if d:
            _, group = np.unique(group * 256 + table[d - 1], return_inverse=True)
        valid = np.flatnonzero((left_size >= d) & (rights >= SPAN - d))
        if not len(valid):
            continue
        both = group[valid] * (n + 1) + np.cumsum(prefix < SPAN - d)[valid]
        _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        hit = valid[counts[inverse] > 1]
        low[hit] = np.where(low[hit] < 0, d, low[hit])
        high[hit] = d
    return low, high


_FOUND = "_doc bigint, _text bigint, start bigint, end bigint"
_HASHED = _FOUND + ", f1 bigint, f2 bigint"


def _merge_part(rows: pa.Table) -> pa.Table:
    """Merge one range's runs; spans of repeats."""
    runs = [_unpacked(r) for r in rows.drop_columns(["part"]).to_pylist()]
    order = list(LoserTree([(r[0], r[1].tolist()) for r in runs]))
    prefix = np.array([o[2] for o in order], dtype=np.int64)
    lefts = [runs[r][2][i] for r, i, _ in order]
    places = np.array([runs[r][3][i] for r, i, _ in order], dtype=np.int64).reshape(-1, 4)
    out: list[tuple] = []
    low, high = repeats_in_order(prefix, np.array([len(runs[r][0][i]) for r, i, _ in order]), lefts)
    for i in np.flatnonzero(high >= 0).tolist():
        unknown, doc, text, at = places[i].tolist()
        out.append((None if unknown else doc, text, at - int(high[i]), at - int(low[i]) + SPAN))
    return pa.Table.from_batches([_arrow(out, _FOUND)])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``_doc, _text, start, end``: byte spans covered by strings of ``SPAN`` bytes that stand elsewhere too."""
    rows = anchor_rows(docs)
    twice = rows.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    # Stored sums leave both sides of a join free, so a frequent core's rows can be split over tasks.
    some = stored(rows.join(stored(twice, "cores"), "core"), "anchors")
    # Anchors with all bytes equal are one item: if it stands twice, all its strings do.
    items = some.groupBy("core", "item1", "item2").agg(
        F.count("*").alias("n"), F.min(F.struct("_doc", "_text", "at")).alias("one")
    )
    items = stored(items, "items")
    settled = items.filter("n > 1").select("core", "item1", "item2")
    full = some.join(settled, ["core", "item1", "item2"]).select(
        "_doc", "_text", (F.col("at") - F.col("left")).cast("bigint").alias("start"),
        (F.col("at") + F.col("right")).cast("bigint").alias("end"),
    )
    # Only cores with several items are left to compare, one anchor of each item.
    several = items.groupBy("core").agg(F.count("*").alias("m")).filter("m > 1").select("core")
    sought = items.join(stored(several, "mixed-cores"), "core").select("one._doc", "one._text", "one.at")
    sought = sought.groupBy("_doc", "_text").agg(F.collect_list("at").alias("places"))
    texts = docs.select(F.col("doc_id"), F.xxhash64("text").alias("_hash"), "text")
    texts = texts.join(sought, F.expr("doc_id <=> _doc AND _hash = _text")).dropDuplicates(["_doc", "_text"])
    runs = stored(sorted_runs(texts), "suffix-runs")
    total = runs.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // PART_ITEMS))
    bounds, shared = splitters(runs, parts)
    exchanged = _cut_runs(runs, bounds, shared)
    exact = exchanged.groupBy("part").applyInArrow(_merge_part, _FOUND)
    if not shared:
        return full.unionByName(exact)
    hashed = stored(_hashed_strings(runs, shared), "hashed-strings")
    # Two anchors may name the same place, which is no repeat of itself.
    place = F.struct(F.col("_doc").isNull().alias("u"), "_doc", "_text", "start")
    again = hashed.groupBy("f1", "f2").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    again = again.filter("a <> b").select("f1", "f2")
    crossing = hashed.join(again, ["f1", "f2"]).select("_doc", "_text", "start", "end")
    return full.unionByName(exact).unionByName(crossing)


def dedup(docs: DataFrame) -> DataFrame:
    """Texts without repeated strings: ``doc_id, n_bytes, n_removed, n_spans, kept`` for every row.

    A byte goes if a string of ``SPAN`` bytes that covers it begins at any other place of the texts,
    the same text included; all places of such a string go. Null texts count as empty; texts under ``SPAN`` bytes stay
    whole; repeated rows are repeats of each other; extra columns are ignored.
    """
    return without_spans(docs, repeated_spans(docs))
