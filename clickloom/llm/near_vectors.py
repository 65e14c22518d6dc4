"""Near-duplicate vectors: cross-polytope hashing, multiprobe buckets, verified pairs.

A hash rotates a vector fast (three rounds of random signs and a Hadamard transform) and
takes the nearest axis. A table joins two hashes; a vector enters its buckets for the two
nearest axes of each, so four buckets a table. Vectors of a bucket are compared in
blocks inside tasks. A pair that meets in several buckets counts in the first only, which
both sides can tell from their keys, so no list of pairs is ever made: a block gives out
one row per linked vector, with its link count and a root in the block's link graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Scratch, components, settle
from clickloom.llm.top_k import usable

#: At a cosine of 0.93 a pair shares no bucket with a chance of 5e-4, at 0.95 of 8e-5.
TABLES, HASHES, PROBES = 5, 2, 2
KEYS = PROBES**HASHES
#: Vectors to a block.
BLOCK = 512
MEMBER = "node bigint, copies bigint, v binary, keys binary"


def _signs(dim: int) -> np.ndarray:
    return np.random.default_rng([dim, 20]).choice([-1.0, 1.0], (TABLES, HASHES, 3, dim))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pseudo-random rotation of the rows of ``x`` (a power of two wide): signs and Hadamard, three times."""
    n, d = x.shape
    for s in signs:
        x = x * s
        h = 1
        while h < d:
            y = x.reshape(n, d // (2 * h), 2, h)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
            h *= 2
    return x


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """Sorted keys (rows, TABLES, KEYS) of the buckets that the rows of ``x`` enter."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - d)))
    out = np.zeros((n, TABLES, KEYS), np.int64)
    for t, table in enumerate(_signs(wide)):
        keys = np.zeros((n, 1), np.int64)
        for signs in table:
            turned = rotate(x, signs)
            axis = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :PROBES]
            code = axis * 2 + (np.take_along_axis(turned, axis, 1) > 0)
            keys = (keys[:, :, None] * (2 * wide) + code[:, None, :]).reshape(n, -1)
        out[:, t] = np.sort(keys, axis=1)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component is taken out first, against overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per vector and bucket."""
    for batch in batches:
        dims = np.diff(batch.column("v").offsets.to_numpy())
        for dim in np.unique(dims):
            for at in np.array_split(np.flatnonzero(dims == dim), max(1, len(dims) // 1024)):
                if not len(at):
                    continue
                part = batch.take(pa.array(at))
                raw = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                keys = bucket_keys(_unit(raw.astype(float)))
                row = np.repeat(np.arange(len(at)), TABLES * KEYS)
                table = np.tile(np.repeat(np.arange(TABLES), KEYS), len(at))
                v = pa.array([r.tobytes() for r in raw], pa.binary())
                k = pa.array([r.tobytes() for r in keys], pa.binary())
                every = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        every.column("label"),
                        pa.array(np.full(len(row), dim, np.int32)),
                        pa.array(table.astype(np.int32)),
                        pa.array(keys.ravel()),
                        every.column("node"),
                        every.column("copies"),
                        v.take(pa.array(row)),
                        k.take(pa.array(row)),
                    ],
                    ["label", "dim", "t", "key", "node", "copies", "v", "keys"],
                )


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows of one label are linked when the cosine of their vectors, in double precision,
    is at least ``cosine``. Rows with a NULL label, and vectors that are NULL, zero, empty
    or hold NULL or non-finite components, link with nothing. Equal vectors are one node
    with a count; every row counts as a vector, one that repeats an id too. Vectors of
    different lengths do not link. Rows without an id are left out; further columns are
    ignored; an empty table gives no rows. The hashes are made for a ``cosine`` of 0.93 or
    more; less raises, as links would be lost.
    """
    if cosine < 0.93:
        raise ValueError("the hashes find pairs with a cosine of 0.93 or more")
    spark = vectors.sparkSession
    # Components keep their type on the way to the tasks; single precision halves the volume.
    kind = np.float32 if vectors.schema[vector_column].dataType.simpleString() == "array<float>" else np.float64
    element = "float" if kind is np.float32 else "double"
    rows = vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast(f"array<{element}>").alias("v"),
    )
    able = usable(F.col("v")) & F.col("label").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumns({"able": able, "f": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), "v")})
    with Scratch(spark) as scratch:
        rows = scratch.table(rows, "vectors")
        print_ = ["label", "f", "g"]
        nodes = scratch.table(
            rows.where("able").groupBy(*print_).agg(
                F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
            ),
            "nodes",
        )
        # One id may carry several vectors; nodes are told apart by number.
        nodes = scratch.table(
            nodes.withColumn("id", F.col("node")).drop("node").withColumn("node", F.monotonically_increasing_id()), "numbered"
        )
        entered = nodes.select("label", "node", "copies", "v").mapInArrow(
            _enter, "label string, dim int, t int, key bigint, " + MEMBER
        )
        bucket = ["label", "dim", "t", "key"]
        sizes = entered.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        sizes = scratch.table(sizes, "buckets")
        entered = entered.join(sizes, bucket).withColumn(
            "block", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / BLOCK)).cast("int")
        )
        packed = entered.groupBy(*bucket, "block").agg(
            F.first("m").alias("m"), F.collect_list(F.struct("node", "copies", "v", "keys")).alias("left")
        )
        packed = scratch.table(packed, "blocks")
        small = packed.where(F.col("m") <= BLOCK).select(
            "t", "key", F.lit(True).alias("same"), "left", F.lit(None).cast(packed.schema["left"].dataType).alias("right")
        )
        large = packed.where(F.col("m") > BLOCK)
        other = large.select(*bucket, F.col("block").alias("other"), F.col("left").alias("right"))
        crossed = large.join(other, bucket).where("block <= other").select(
            "t", "key", (F.col("block") == F.col("other")).alias("same"), "left", "right"
        )

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    t, key, same = (batch.column(c)[i].as_py() for c in range(3))
                    left = _members(batch.column(3)[i], kind)
                    right = left if same else _members(batch.column(4)[i], kind)
                    yield _links(left, right, same, t, key, cosine)

        found = small.unionByName(crossed).mapInArrow(compare, "node bigint, n bigint, root bigint")
        found = scratch.table(found, "links")
        counts = found.groupBy("node").agg(F.sum("n").alias("n"))
        part = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        ids = nodes.select("node", "id", "copies", *print_).join(part, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        least = ids.groupBy("component").agg(F.min("id").alias("component_id"))
        ids = ids.join(least, "component").join(counts, "node", "left")
        ids = ids.select(*print_, "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
        ids = scratch.table(ids, "found")
        linked = rows.where("able").join(ids, print_).select("vec_id", "n_links", "component_id")
        alone = rows.where("NOT able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return settle(linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id")))


def _members(cell: pa.ListScalar, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node numbers, copies, unit vectors and bucket keys of a packed block."""
    values = cell.values
    v = np.frombuffer(b"".join(values.field("v").to_pylist()), kind).reshape(len(values), -1)
    keys = np.frombuffer(b"".join(values.field("keys").to_pylist()), np.int64).reshape(-1, TABLES, KEYS)
    return values.field("node").to_numpy(), values.field("copies").to_numpy(), _unit(v.astype(float)), keys


def _links(left: tuple, right: tuple, same: bool, t: int, key: int, cosine: float) -> pa.RecordBatch:
    """Links between two blocks that no earlier bucket has: (node, links with copies, root)."""
    a, b = left, right
    close = a[2] @ b[2].T >= cosine
    i, j = np.nonzero(np.triu(close, 1) if same else close)
    keep = []
    for start in range(0, len(i), 20_000):
        x, y = a[3][i[start : start + 20_000]], b[3][j[start : start + 20_000]]
        shared = (x[:, :, :, None] == y[:, :, None, :]).any(axis=3)
        first = shared.any(axis=2).argmax(axis=1)
        row = np.arange(len(x))
        least = x[row, first, shared[row, first].argmax(axis=1)]
        keep.append((first == t) & (least == key))
    if keep:
        some = np.concatenate(keep)
        i, j = i[some], j[some]
    node, copies = (np.concatenate([a[c], b[c]]) for c in (0, 1))
    j = j if same else j + len(a[0])
    n = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
    # Roots: the least member reached, by spreading the minimum until nothing changes.
    root = np.arange(len(node))
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(node[some]), pa.array(n[some].astype(np.int64)), pa.array(node[root[some]])], ["node", "n", "root"]
    )
