"""Exact top-k search by distributed histogram selection.

All scores are integers. Every round scores the query blocks against all candidate blocks
and sums score histograms per query, each bin a range of scores; the bin that holds the
k-th value is divided anew in the next round until bins are single values. A last round
keeps the scores from the k-th value up and breaks ties by the smaller id. Scores are
computed again in each round and never stored; what leaves a block is at most k bins or
rows per query.

Blocks meet in a grid of query slices and candidate groups, one task to a cell. Its sides are
such that copying queries to all groups moves about as much as copying candidates to all
slices, so what a round moves grows with the square root of the cells. Both sides are
shuffled: the planner takes the copied blocks for as small as the rows they come from.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import Scratch, settle

#: Bins per round as a power of two.
BIN_BITS = 11
#: Rows to a block.
QUERY_ROWS = 512
CANDIDATE_ROWS = 2048

BLOCK = "g int, dim int, ids binary, hashes binary, vectors binary"

#: Bytes to a component of a block, the fewest that hold all of them.
WIDTHS = {2: np.int16, 4: np.int32, 8: np.int64}


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL, NaN or infinite components."""
    return F.coalesce(
        vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
        F.lit(False),
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query.

    Components become ``floor(scale * x)`` (cut to the range of a long); the score is the
    inner product (likewise cut). Candidates are all rows with another id and a vector of
    the same length. Rows with NULL ids or unusable vectors take no part. An id may occur
    in several rows: each is a candidate, each different vector a query, equal ones the
    same query. Empty vectors score 0. Fewer than k candidates are all returned; further
    columns are left out. ``is_query`` may name any column of ``vectors``.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.where(usable(F.col(vector_column)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(vector_column, lambda x: F.floor(x.cast("double") * scale)).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.withColumn("dim", F.size("v")).withColumn("h", F.xxhash64("v"))
    with Scratch(spark) as scratch:
        rows = scratch.table(rows, "vectors")
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        # ``~x`` is -x - 1, which every long has.
        far = F.greatest(F.array_max("v"), F.bitwise_not(F.array_min("v")))
        bound, far, n, n_asks = rows.agg(F.max(norm), F.max(far), F.count(F.lit(1)), F.count_if("asks")).first()
        if bound is None:
            return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
        kind = next(t for t in WIDTHS.values() if (far or 0) <= np.iinfo(t).max)
        grid = _grid(parts, n, n_asks)
        dealt = rows.select(F.pmod(F.xxhash64("id", "h", F.spark_partition_id()), F.lit(grid[1])).cast("int").alias("g"), "dim", "id", "h", "v")
        candidates = scratch.table(dealt.repartition(parts, "g").mapInArrow(_packer(kind), BLOCK), "candidates")
        asked = rows.where("asks").groupBy("id", "h", "dim").agg(F.first("v").alias("v"))
        asked = scratch.table(asked.withColumns({"base": F.lit(None).cast("long"), "need": F.lit(k).cast("long")}), "queries")

        shift = max(0, int(bound).bit_length() + 2 - BIN_BITS)
        before = 64
        while True:
            counts = _scored(asked, candidates, grid, kind, k, bound, before, shift).groupBy("id", "h", "bin").agg(
                F.sum("n").alias("n")
            )
            down = Window.partitionBy("id", "h").orderBy(F.col("bin").desc())
            reached = counts.withColumn("upto", F.sum("n").over(down)).withColumnsRenamed({"id": "qid", "h": "qh"})
            hit = (
                reached.join(asked.select("id", "h", "need"), (F.col("qid") == F.col("id")) & (F.col("qh") == F.col("h")))
                .where(F.col("upto") >= F.col("need"))
                .groupBy("id", "h")
                .agg(F.max(F.struct("bin", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))).alias("hit"))
                .withColumnsRenamed({"id": "qid", "h": "qh"})
            )
            # A query with fewer than k candidates has no hit and takes all scores.
            asked = scratch.table(
                asked.drop("base", "need")
                .join(hit, (F.col("qid") == F.col("id")) & (F.col("qh") == F.col("h")), "left")
                .select("id", "h", "dim", "v", F.col("hit.bin").alias("base"), F.coalesce("hit.need", F.lit(k)).cast("long").alias("need")),
                "queries",
            )
            if shift == 0:
                break
            before, shift = shift, max(0, shift - BIN_BITS)
        best = _scored(asked, candidates, grid, kind, k, bound, None, 0)
        order = Window.partitionBy("id", "h").orderBy(F.col("bin").desc(), "n")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return settle(
            ranked.select(F.col("id").alias("query_id"), "rank", F.col("n").alias("vec_id"), F.col("bin").alias("score"))
        )


def _grid(cells: int, candidates: int, queries: int) -> tuple[int, int]:
    """Slices of the queries and groups of the candidates, about as many of both together as ``cells``."""
    groups = min(cells, max(1, round(math.sqrt(cells * candidates / max(1, queries)))))
    return -(-cells // groups), groups


def _scored(
    asked: DataFrame,
    candidates: DataFrame,
    grid: tuple[int, int],
    kind: type,
    k: int,
    bound: float,
    before: int | None,
    shift: int,
) -> DataFrame:
    """Histograms (id, h, bin, n) of all queries, or with ``before=None`` best rows (id, h, score, vec_id).

    Each query block of every slice ``s`` meets the candidate blocks of every group ``g`` by an equi-join.
    """
    slices, groups = grid
    sliced = F.pmod(F.xxhash64("id", "h"), F.lit(slices)).cast("int").alias("s")
    blocks = asked.select(sliced, "dim", "id", "h", "v", "base", "need").mapInArrow(
        _query_packer(kind), "s int, dim int, qids binary, qhashes binary, qvectors binary, base binary, need binary"
    )
    blocks = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    candidates = candidates.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    exact = bound * 2 < 2**53

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = _block(row, kind, k, exact, before, shift)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["id", "h", "bin", "n"])

    return blocks.hint("merge").join(candidates, ["s", "g", "dim"]).drop("s", "g").mapInArrow(score, "id bigint, h bigint, bin bigint, n bigint")


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, dim)


def _groups(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Rows of one group and dimension, at most ``size`` at a time."""
    key = np.stack([_long(batch.column(0)), _long(batch.column(1))], 1)
    for g, dim in np.unique(key, axis=0) if len(key) else ():
        at = np.flatnonzero((key == (g, dim)).all(axis=1))
        for i in range(0, len(at), size):
            yield int(g), int(dim), batch.take(pa.array(at[i : i + size]))


def _packer(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (g, dim, id, h, v) to blocks, with components of the type ``kind``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, dim, rows in _groups(batch, CANDIDATE_ROWS):
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "g": g,
                            "dim": dim,
                            "ids": _long(rows.column(2)).tobytes(),
                            "hashes": _long(rows.column(3)).tobytes(),
                            "vectors": _matrix(rows.column(4), dim).astype(kind).tobytes() if dim else b"",
                        }
                    ],
                    pa.schema([("g", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("hashes", pa.binary()), ("vectors", pa.binary())]),
                )

    return pack


def _query_packer(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (s, dim, id, h, v, base, need) to blocks, with components of the type ``kind``."""
    low = np.iinfo(np.int64).min
    names = ["s", "dim", "qids", "qhashes", "qvectors", "base", "need"]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, dim, rows in _groups(batch, QUERY_ROWS):
                base = rows.column(5).fill_null(low)
                values = [
                    s,
                    dim,
                    _long(rows.column(2)).tobytes(),
                    _long(rows.column(3)).tobytes(),
                    _matrix(rows.column(4), dim).astype(kind).tobytes() if dim else b"",
                    _long(base).tobytes(),
                    _long(rows.column(6)).tobytes(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    return pack


def _block(row: dict, kind: type, k: int, exact: bool, before: int | None, shift: int) -> tuple[np.ndarray, ...]:
    """Scores of one query block against one candidate block, brought down to k per query."""
    dim, low = row["dim"], np.iinfo(np.int64).min

    def longs(name: str) -> np.ndarray:
        return np.frombuffer(row[name], np.int64)

    def matrix(name: str) -> np.ndarray:
        return np.frombuffer(row[name], kind).reshape(-1, dim)

    ids, qids, base = longs("ids"), longs("qids"), longs("base")
    if not dim:
        scores = np.zeros((len(qids), len(ids)), np.int64)
    elif exact:
        # Sums stay below 2**53, so doubles hold them exactly.
        q, c = matrix("qvectors"), matrix("vectors")
        scores = (q.astype(float) @ c.astype(float).T).astype(np.int64)
    else:
        q, c = matrix("qvectors"), matrix("vectors")
        scores = np.clip(q.astype(object) @ c.astype(object).T, low + 1, -(low + 1)).astype(np.int64)
    scores[qids[:, None] == ids[None, :]] = low
    # No score below the block's own k-th can be among the best k of all.
    least = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(qids), low)
    keep = (scores >= least[:, None]) & (scores > low)
    if before is None:
        # ``base`` is the k-th value itself, or the lowest long where all are wanted.
        i, j = np.nonzero(keep & (scores >= base[:, None]))
        best = scores[i, j]
        order = np.lexsort((ids[j], -best, i))
        i, j, best = i[order], j[order], best[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, best = i[rank < k], j[rank < k], best[rank < k]
        return qids[i], longs("qhashes")[i], best, ids[j]
    if before < 64:
        keep &= (scores >> before) == base[:, None]
    i, j = np.nonzero(keep)
    found, n = np.unique(np.stack([i, scores[i, j] >> shift], 1), axis=0, return_counts=True)
    return qids[found[:, 0]], longs("qhashes")[found[:, 0]], found[:, 1], n


__all__ = ["top_k", "usable"]
