"""Exact top-k by inner product, block at a time, with bounds from each block's component extremes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stored

SCALE = 256  # Fixed value: components are floor(256 * x).
TOP, QUERY_STEP = 5, 50  # Fixed values: results of a query, and which ids are queries.
BLOCK = 256  # vectors of a document-range block
QUERIES = 2048  # most queries of a cell
SHARD_BLOCKS = 64  # blocks of a cell
LEAST_SCORE, MOST_SCORE = -(2**63), 2**63 - 1


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, dims``: whole-number components; rows with a null id, vector or component, or one not finite, go.

    A component outside the range of long becomes its nearest end.
    """
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(good)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.select("vec_id", scaled.alias("v"), F.size("embedding").alias("dims"))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Forward indexes of ranges of ids: at most ``size`` vectors of one length in a row.

    Returns ``block, dims, ids, values`` (little-endian 64-bit numbers, row by row), ``high`` and
    ``low``, the largest and smallest value of each component.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            flat, ids = batch.column(1), batch.column(0).to_numpy(zero_copy_only=False)
            values = flat.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(dims)))
            change = np.flatnonzero(np.diff(dims)) + 1
            rows: list[tuple] = []
            for a, b in zip([0, *change], [*change, len(dims)], strict=True):
                for s in range(a, b, size):
                    e = min(b, s + size)
                    part = values[offsets[s] : offsets[e]].reshape(e - s, dims[s]).astype("<i8")
                    rows.append((int(dims[s]), ids[s:e].astype("<i8"), part, part.max(axis=0), part.min(axis=0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32())]
                + [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(1, 5)],
                names=["dims", "ids", "values", "high", "low"],
            )

    ranged = vectors.repartitionByRange("dims", "vec_id").sortWithinPartitions("dims", "vec_id")
    return ranged.mapInArrow(cut, "dims int, ids binary, values binary, high binary, low binary")


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, best first, ties to smaller ids."""
    if scores.dtype == object:  # whole numbers beyond 64 bits
        rows = range(scores.shape[1])
        order = [sorted(rows, key=lambda j: (-s[j], i[j]))[:k] for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
        order = np.array(order)
    else:
        order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search_cell(queries: list[tuple], documents: list[tuple], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Best matches of query blocks among document blocks of the same vector length.

    Each query visits blocks from the highest bound down. The bound of a block adds, per component,
    the query's value times the block's largest or smallest one; once it is below the k-th score so far, or below ``floors``,
    k-th scores known from elsewhere, no later block can matter. Queries that are at the same block share a matrix product.
    """
    for ids, values, floors in queries:
        mine = [b for b in documents if b[1].shape[1] == values.shape[1]]
        best, found = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
        if not mine:
            yield best, found
            continue
        high, low = np.stack([b[2] for b in mine]), np.stack([b[3] for b in mine])
        # Sums below 2**53 are exact as doubles; larger ones use whole numbers without a limit.
        largest = float(np.abs(values.astype(float)).max(initial=0)) * float(np.abs(np.stack([high, low]).astype(float)).max(initial=0))
        kind = np.float64 if largest * values.shape[1] < 2**53 else object
        q = values.astype(kind)
        bound = np.maximum(q, 0) @ high.T.astype(kind) + np.minimum(q, 0) @ low.T.astype(kind)
        bound = bound.astype(np.float64)
        if kind is object:
            bound += np.abs(bound) * 1e-9  # rounding must not lower a bound
        bound = np.maximum(bound, float(LEAST_SCORE))
        order = np.argsort(-bound, axis=1, kind="stable")
        best = best.astype(kind)
        for turn in range(len(mine)):
            at = order[:, turn]
            kth = np.maximum(best[:, -1].astype(np.float64), floors)
            active = np.flatnonzero(bound[np.arange(len(q)), at] >= kth)
            if not len(active):
                break
            for number in np.unique(at[active]):
                rows = active[at[active] == number]
                other = mine[number][0]
                scores = q[rows] @ mine[number][1].T.astype(kind)
                if kind is object:
                    scores = np.clip(scores, LEAST_SCORE, MOST_SCORE)
                scores[ids[rows][:, None] == other[None, :]] = -np.inf
                all_ids = np.concatenate((found[rows], np.broadcast_to(other, scores.shape)), axis=1)
                best[rows], found[rows] = _top(np.concatenate((best[rows], scores), axis=1), all_ids, k)
        yield best, found


def _arrays(row: dict) -> tuple:
    ids = np.frombuffer(row["ids"], dtype="<i8")
    values = np.frombuffer(row["values"], dtype="<i8").reshape(len(ids), row["dims"])
    return ids, values, *[np.frombuffer(row[n], dtype="<i8") for n in ("high", "low")]


def search(asked: DataFrame, forward: DataFrame, k: int) -> DataFrame:
    """``query, query_id, nth, found, scores, kth`` of each query block and cell: its ``k`` best among the cell's blocks.

    ``asked`` has ``query``, a block's number, and ``floors``; both sides have the cell they meet in. Ids and scores are rows of ``k``
    little-endian numbers, fewer matches marked by the largest id; ``kth`` are the k-th scores.
    """

    def cell(rows: pa.Table) -> pa.Table:
        queries, documents, numbers = [], [], []
        for r in rows.to_pylist():
            ids, values, high, low = _arrays(r)
            if r["query"] is None:
                documents.append((ids, values, high, low))
            else:
                floors = np.frombuffer(r["floors"], dtype="<f8") if r["floors"] else np.full(len(ids), -np.inf)
                queries.append((ids, values, floors))
                numbers.append(r["query"])
        out: dict[str, list] = {n: [] for n in ("query", "query_ids", "found", "scores", "kth")}
        for number, (ids, _, _), (best, found) in zip(numbers, queries, search_cell(queries, documents, k), strict=True):
            out["query"].append(number)
            out["query_ids"].append(ids.tobytes())
            found = np.where(best == -np.inf, np.iinfo(np.int64).max, found)
            out["found"].append(found.astype("<i8").tobytes())
            whole = np.array([[0 if s == -np.inf else int(s) for s in row] for row in best.tolist()], dtype="<i8")
            out["scores"].append(whole.tobytes())
            out["kth"].append(best[:, -1].astype("<f8").tobytes())
        kinds = {"query": pa.int64()}
        return pa.table({n: pa.array(v, kinds.get(n, pa.binary())) for n, v in out.items()})

    documents = forward.select("*", F.lit(None).cast("bigint").alias("query"), F.lit(None).cast("binary").alias("floors"))
    both = asked.unionByName(documents.select(*asked.columns))
    schema = "query bigint, query_ids binary, found binary, scores binary, kth binary"
    return both.groupBy("cell_q", "cell_d").applyInArrow(cell, schema)


def _matches(parts: DataFrame, k: int) -> DataFrame:
    """``query, nth, query_id, vec_id, score``: the rows behind the binary columns of :func:`search`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, found, scores = (np.frombuffer(r[n], dtype="<i8") for n in ("query_ids", "found", "scores"))
                at = np.flatnonzero(found != np.iinfo(np.int64).max)
                columns = [np.full(len(at), r["query"]), at // k, ids[at // k], found[at], scores[at]]
                names = ["query", "nth", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return parts.mapInArrow(rows, "query bigint, nth bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, k: int = TOP, query_step: int = QUERY_STEP, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest inner products of each query.

    Queries are the rows whose ``vec_id`` is divisible by ``query_step``; candidates are all rows
    with another ``vec_id`` and a vector of the same length. Rows with null ids, and vectors
    that are null or hold null or non-finite components, take no part. Repeated rows count
    each, as candidates and as queries, and so do different vectors with one id; extra columns are ignored; without rows there
    are no results. Components and scores outside the range of long count as its nearest end, in the order of scores too.

    Query groups meet document shards in cells; a cell holds a bounded number of both. The first shard goes
    first: the k-th scores found there are the floor below which all others skip their blocks.
    """
    whole = integer_vectors(vectors)
    forward = stored(blocks(whole, BLOCK), "vector-blocks")
    asked = blocks(whole.filter(F.col("vec_id") % query_step == 0), QUERIES)
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()), "query-blocks")
    shards = max(1, -(-forward.count() // shard_blocks))
    groups = max(1, asked.count())
    asked = asked.withColumn("cell_q", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    forward = forward.withColumn("cell_d", F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int"))
    forward = forward.withColumn("cell_q", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    first = asked.withColumn("cell_d", F.lit(0)).withColumn("floors", F.lit(None).cast("binary"))
    parts = search(first, forward.filter("cell_d = 0"), k)
    if shards > 1:
        parts = stored(parts, "first-matches")
        floors = parts.select("query", F.col("kth").alias("floors"))
        rest = asked.join(floors, "query").withColumn("cell_d", F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
        parts = parts.unionByName(search(rest.select(*first.columns), forward.filter("cell_d > 0"), k))
    order = Window.partitionBy("query", "nth").orderBy(F.desc("score"), "vec_id")
    ranked = _matches(parts, k).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
