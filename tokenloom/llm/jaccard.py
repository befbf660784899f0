"""N-gram Jaccard join: MinHash candidates, Bayesian pruning of pairs, exact check of the rest.

Texts with the same shingle set are one class, and only a class's representative is compared.
Pairs are never rows: a bucket of similar texts is cut into blocks, and a task compares two
blocks, passing on links per text and the edges of a spanning forest only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import row_key, stored
from tokenloom.llm.shingles import shingle_sets

THRESHOLD = 0.8  # Fixed value: the Jaccard similarity of a link.
HASHES, ROWS = 128, 4  # MinHash values, and values of a band: a link is missed once in 20 million
BANDS = HASHES // ROWS
STEPS = (16, 32, 64, 128)  # after so many values a pair may be dropped
TOLERANCE = 1e-6  # a pair is dropped below this posterior probability of a link
BLOCK = 256  # mean texts of a block
_RANDOM = np.random.default_rng(11).integers(1, 2**63, (2, HASHES), dtype=np.uint64)
_MULTIPLY = _RANDOM[0] * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM[1]


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each step n, the fewest equal values among n with which a pair stays.

    The prior of the similarity is flat. Values are compared by their last byte, so different ones
    are equal once in 256 times. The posterior's tail above the threshold is summed on a fine grid.
    """
    grid = np.linspace(0, 1, 20001)[1:-1]
    equal = grid + (1 - grid) / 256
    out = {}
    for n in STEPS:
        for m in range(n + 1):
            log = m * np.log(equal) + (n - m) * np.log1p(-equal)
            law = np.exp(log - log.max())
            if law[grid >= threshold].sum() / law.sum() >= tolerance:
                out[n] = m
                break
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """``_row, _doc, _class, _n, _keys, _sig`` per row of ``docs``.

    The 128-bit name and the size of its shingle set, a key per band of MinHash values, and the
    last byte of each value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = shingle_sets([(t or "").encode() for t in part.column(2).to_pylist()])
                names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                filled = [i for i, s in enumerate(sets) if len(s)]
                sigs: list[bytes | None] = [None] * len(sets)
                keys: list[bytes | None] = [None] * len(sets)
                if filled:
                    values = np.concatenate([sets[i] for i in filled])
                    begins = np.cumsum([0, *(len(sets[i]) for i in filled[:-1])])
                    table = np.empty((len(filled), HASHES), dtype=np.uint32)
                    for k in range(HASHES):
                        hashed = ((values * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
                        table[:, k] = np.minimum.reduceat(hashed, begins)
                    for i, row, key in zip(filled, table.astype(np.uint8), _band_keys(table), strict=True):
                        sigs[i], keys[i] = row.tobytes(), key.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(names, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["_row", "_doc", "_class", "_n", "_keys", "_sig"],
                )

    rows = docs.select(row_key("doc_id", "text").alias("_row"), F.col("doc_id").alias("_doc"), "text")
    return rows.mapInArrow(run, "_row binary, _doc bigint, _class binary, _n bigint, _keys binary, _sig binary")


def _band_keys(sigs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of MinHash values."""
    wide = sigs.reshape(len(sigs), BANDS, ROWS).astype(np.uint64)
    keys = np.zeros((len(sigs), BANDS), dtype=np.uint64)
    for i in range(ROWS):
        keys = (keys ^ wide[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def _band_rows(reps: DataFrame) -> DataFrame:
    """``id, band, key`` of every representative, 32 rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
                ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
                bands = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(bands), pa.array(keys)], names=["id", "band", "key"]
                )

    return reps.select("id", "_keys").mapInArrow(run, "id bigint, band int, key bigint")


def _block_pairs(rows: DataFrame, members: str) -> DataFrame:
    """One row per row and block pair it belongs to: adds ``left``, ``right`` and ``side``.

    ``members`` names the number of rows in a row's bucket. Rows are dealt to
    ``members / BLOCK`` blocks by hash; blocks i <= j form a pair, so a row is copied once per block.
    """
    blocks = F.greatest(F.ceil(F.col(members) / BLOCK), F.lit(1)).cast("int")
    dealt = rows.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    both = dealt.select("*", other)
    return both.select(
        "*", F.least("_own", "_other").alias("left"), F.greatest("_own", "_other").alias("right")
    ).drop("_blocks", "_other")


def _grouped(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table], schema: str, batch: str) -> DataFrame:
    """Run ``work`` on many whole groups at a time.

    Groups are first put into batches by ``batch``, a hash of their key, as most hold a few rows and a call for each
    would cost more than its work. ``work`` gets rows sorted by ``keys`` and ``id``.
    """

    def run(part: pa.Table) -> pa.Table:
        return work(part.sort_by([(k, "ascending") for k in [*keys, "id"]]))

    return rows.groupBy(batch).applyInArrow(run, schema)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest connected index of each of n nodes joined by the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        # Old roots follow too, so long chains shrink by half each time.
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _group_pairs(starts: np.ndarray, ends: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, limit: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of all groups, at most about ``limit`` at a time.

    In a group of two different blocks only pairs between them count: those inside a block
    belong to the group of the block with itself.
    """
    hold_a, hold_b, held = [], [], 0
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        if left[s] == right[s]:
            rows = range(s, e - 1)
            parts = [(np.full(e - i - 1, i), np.arange(i + 1, e)) for i in rows]
        else:
            one, two = s + np.flatnonzero(own[s:e] == left[s]), s + np.flatnonzero(own[s:e] == right[s])
            parts = [(np.full(len(two), i), two) for i in one.tolist()] if len(two) else []
        for a, b in parts:
            hold_a.append(a)
            hold_b.append(b)
            held += len(a)
            if held >= limit:
                yield np.concatenate(hold_a), np.concatenate(hold_b)
                hold_a, hold_b, held = [], [], 0
    if held:
        yield np.concatenate(hold_a), np.concatenate(hold_b)


def _edges(sorted_rows: pa.Table, least: dict[int, int]) -> pa.Table:
    """Spanning edges of the pairs that the Bayesian test keeps, in groups of two blocks of a band bucket.

    Trees hang on the smallest ids, and the buckets of a group of similar texts mostly come in the same batch,
    whatever their band, so a group gives about one edge per text.
    """
    n = sorted_rows.num_rows
    ids = sorted_rows["id"].to_numpy()
    sigs = np.frombuffer(b"".join(sorted_rows["_sig"].to_pylist()), dtype=np.uint8).reshape(n, HASHES)
    sizes = sorted_rows["_n"].to_numpy()
    columns = [sorted_rows[c].to_numpy() for c in ("band", "key", "left", "right")]
    cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [n]))
    # A text has a row per band: pairs are told by text, so those of several bands count once.
    names, at, node = np.unique(ids, return_index=True, return_inverse=True)
    found_a, found_b = [], []
    for a, b in _group_pairs(starts, ends, sorted_rows["_own"].to_numpy(), columns[2], columns[3]):
        a, b = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
        a, b = np.divmod(np.unique(a * len(names) + b), len(names))
        small, large = np.minimum(sizes[at[a]], sizes[at[b]]), np.maximum(sizes[at[a]], sizes[at[b]])
        stay = small >= THRESHOLD * large
        a, b = a[stay], b[stay]
        equal, done = np.zeros(len(a), dtype=np.int32), 0
        for step in STEPS:
            equal += (sigs[at[a], done:step] == sigs[at[b], done:step]).sum(axis=1, dtype=np.int32)
            done = step
            stay = equal >= least[step]
            a, b, equal = a[stay], b[stay], equal[stay]
        found_a.append(a)
        found_b.append(b)
    a, b = np.concatenate([*found_a, np.zeros(0, int)]).astype(int), np.concatenate([*found_b, np.zeros(0, int)]).astype(int)
    root = _forest(a, b, len(names))
    moved = np.flatnonzero(root != np.arange(len(names)))
    return pa.table({"a": pa.array(names[root[moved]], pa.int64()), "b": pa.array(names[moved], pa.int64())})


def components(edges: DataFrame, label: str = "cluster") -> DataFrame:
    """``id, label``: the smallest id connected to each id of ``edges(a, b)``.

    Each round a node takes the least label of its neighbours, and each label then takes its own
    label, so chains shrink by half. Rounds are written to the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct().filter("a <> b"), "edges")
    now = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("l")), "labels")
    while True:
        near = both.join(now, F.col("b") == F.col("id")).groupBy(F.col("a").alias("id")).agg(F.min("l").alias("m"))
        low = now.join(near, "id").select("id", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        # The label of the own label: ids that are labels are nodes too.
        roots = now.select(F.col("id").alias("l2"), F.col("l").alias("ll"))
        nexts = low.join(roots, F.col("l") == F.col("l2"), "left").select(
            "id", F.least("l", F.coalesce("ll", "l")).alias("l"), "old"
        )
        nexts = stored(nexts, "labels")
        if nexts.filter("l <> old").isEmpty():
            return nexts.select("id", F.col("l").alias(label))
        now = nexts.select("id", "l")


def _links(sorted_rows: pa.Table) -> pa.Table:
    """Exact links between the texts of two blocks of a cluster.

    Returns, per text, how many rows it links to in the other block, and the edges of a spanning
    forest as rows with ``other`` set.
    """
    n = sorted_rows.num_rows
    ids, copies = sorted_rows["id"].to_numpy(), sorted_rows["copies"].to_numpy()
    sets = shingle_sets([t.encode() for t in sorted_rows["text"].to_pylist()])
    sizes = np.array([len(s) for s in sets])
    columns = [sorted_rows[c].to_numpy() for c in ("cluster", "left", "right")]
    cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [n]))
    own = sorted_rows["_own"].to_numpy()
    counts, edge_a, edge_b = np.zeros(n, dtype=np.int64), [], []
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        # A matrix product of small 0/1 matrices over the group's shingles gives all overlaps.
        values, place, uses = np.unique(np.concatenate(sets[s:e]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(e - s), sizes[s:e])
        common = np.flatnonzero(uses > 1)  # others are in no overlap
        number = np.full(len(values), -1)
        number[common] = np.arange(len(common))
        row, place = row[number[place] >= 0], number[place][number[place] >= 0]
        one = np.arange(e - s) if columns[1][s] == columns[2][s] else np.flatnonzero(own[s:e] == columns[1][s])
        two = one if columns[1][s] == columns[2][s] else np.flatnonzero(own[s:e] == columns[2][s])
        if not len(one) or not len(two):
            continue
        shared = np.zeros((e - s, e - s), dtype=np.float32)
        # Shingles are taken some thousand at a time, so the matrices stay small.
        width = max(1, 4_000_000 // (e - s))
        for begin in range(0, len(common), width):
            inside = (place >= begin) & (place < begin + width)
            table = np.zeros((e - s, min(width, len(common) - begin)), dtype=np.float32)
            table[row[inside], place[inside] - begin] = 1
            shared += table @ table.T
        size = sizes[s:e].astype(np.float64)
        union = size[:, None] + size[None, :] - shared
        linked = shared >= THRESHOLD * union - 1e-9
        np.fill_diagonal(linked, False)
        if one is not two:
            side = np.zeros(e - s, dtype=bool)
            side[one] = True
            linked &= side[:, None] != side[None, :]
        counts[s:e] = linked @ copies[s:e]
        a, b = np.nonzero(np.triu(linked))
        root = _forest(a, b, e - s)
        moved = np.flatnonzero(root != np.arange(e - s))
        edge_a.append(ids[s + moved])
        edge_b.append(ids[s + root[moved]])
    some = np.flatnonzero(counts)
    a, b = np.concatenate([*edge_a, ids[:0]]), np.concatenate([*edge_b, ids[:0]])
    return pa.table(
        {
            "id": pa.array(np.concatenate((ids[some], a)), pa.int64()),
            "other": pa.array([None] * len(some) + b.tolist(), pa.int64()),
            "links": pa.array(np.concatenate((counts[some], np.zeros(len(a), np.int64))), pa.int64()),
        }
    )


def join(docs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, class_id, n_links, representative`` for every row of ``docs``.

    ``class_id`` is the smallest ``doc_id`` of all rows that chains of links connect to a row, and
    ``n_links`` the number of other rows whose five-word shingles have a Jaccard similarity of 0.8
    or more with its own. ``representative`` marks one row of each class. Rows with equal shingle
    sets are linked, repeated rows too. Texts without words, null ones included, have no links and are a class of their own each;
    for a null ``doc_id`` the class id is null unless it is linked. Extra columns are ignored.
    """
    signed = stored(signatures(docs), "signatures")
    # Texts without words stay alone; of the others one row stands for its shingle set.
    worded = signed.filter("_n > 0")
    classes = worded.groupBy("_class").agg(
        F.min(F.struct(F.col("_doc").isNull().alias("u"), "_doc", "_row")).alias("_least"),
        F.count("*").alias("copies"),
        F.first("_n").alias("_n"),
        F.first("_keys").alias("_keys"),
        F.first("_sig").alias("_sig"),
    )
    classes = classes.select(
        F.xxhash64("_class").alias("id"), "_class", "copies", "_n", "_keys", "_sig",
        F.col("_least._doc").alias("_doc"), F.col("_least._row").alias("_row"),
    )
    classes = stored(classes, "classes")
    bands = stored(_band_rows(classes), "bands")
    buckets = bands.groupBy("band", "key").agg(F.count("*").alias("members"), F.min("id").alias("first"))
    buckets = buckets.filter("members > 1")
    shared = bands.join(buckets, ["band", "key"]).join(classes.select("id", "_n", "_sig"), "id")
    pairs = _block_pairs(shared, "members")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = F.lit(16 * partitions)
    pairs = pairs.withColumn("_slot", F.pmod(F.xxhash64("first", "left", "right"), slots))
    least = least_matches(tolerance=tolerance)
    near = _grouped(pairs, ["band", "key", "left", "right"], lambda t: _edges(t, least), "a bigint, b bigint", "_slot")
    clusters = components(near)
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    rows = clusters.join(sizes, "cluster").join(classes.select("id", "copies", "_row"), "id")
    texts = docs.select(row_key("doc_id", "text").alias("_row"), "text").join(rows, "_row").dropDuplicates(["id"])
    checked = _block_pairs(stored(texts.select("id", "cluster", "members", "copies", "text"), "cluster-texts"), "members")
    checked = checked.withColumn("_slot", F.pmod(F.xxhash64("cluster", "left", "right"), slots))
    found = _grouped(
        checked.select("id", "cluster", "copies", "text", "left", "right", "_own", "_slot"),
        ["cluster", "left", "right"], _links, "id bigint, other bigint, links bigint", "_slot",
    )
    found = stored(found, "links")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    final = components(found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")), "class")
    named = classes.join(final, "id", "left").join(counted, "id", "left").select(
        "_class", "copies", "_doc", "_row", F.coalesce("class", "id").alias("class"), F.coalesce("links", F.lit(0)).alias("links")
    )
    # The smallest doc_id of a class, and the row that carries it.
    firsts = named.groupBy("class").agg(
        F.min(F.struct(F.col("_doc").isNull().alias("u"), "_doc", "_row")).alias("f")
    ).select("class", F.col("f._doc").alias("class_id"), F.col("f._row").alias("_first"))
    named = stored(named.join(firsts, "class").select("_class", "copies", "links", "class_id", "_first"), "class-names")
    linked = worded.join(named, "_class").select(
        F.col("_doc").alias("doc_id"), "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"),
        (F.col("_row") == F.col("_first")).alias("representative"), "_row",
    )
    alone = signed.filter("_n = 0").select(
        F.col("_doc").alias("doc_id"), F.col("_doc").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"),
        F.lit(True).alias("representative"), "_row",
    )
    return linked.unionByName(alone)


def one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest ``doc_id``.

    Of exactly repeated rows one stays; rows without words all stay.
    """
    kept = join(docs).filter("representative").select(F.col("_row").alias("__row")).distinct()
    keyed = docs.withColumn("__row", row_key("doc_id", "text")).join(kept, "__row", "left_semi")
    worded = F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    twice = keyed.filter(worded).dropDuplicates(["__row"])
    return twice.unionByName(keyed.filter(~worded)).select(*docs.columns)
