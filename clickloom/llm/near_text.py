"""Near-duplicate texts: one-permutation MinHash, banded buckets, star-shaped candidates.

Each text is hashed once; the hash range is cut into one bin per signature value, and the
least hash in a bin is its value. An empty bin takes the value of the first full bin in a
random order of its own (optimal densification), so its chance to agree stays the
similarity. Texts with equal bands meet in a bucket, and each bucket gives an edge from
its smallest id to every other member, not all pairs. Edges are confirmed on the full
shingle sets. Buckets whose members the confirmed edges leave in several components are
then compared exhaustively, block against block of signatures, and pairs of different
components whose signatures are close are confirmed too; so a star whose centre is unlike
its members loses no link between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Scratch, components, settle
from clickloom.llm.shingles import U, mix, shingle_sets

#: At a similarity of 0.8 a pair shares no bucket with a chance of 5e-6.
BANDS, ROWS = 40, 6
BINS = BANDS * ROWS
#: Signatures that agree in fewer values belong to pairs below 0.8 (six standard deviations).
CLOSE = 0.64
#: Members, and shingles of them, to a block in the exhaustive comparison.
BLOCK, CELLS = 256, 1 << 21

EDGES = (np.arange(BINS, dtype=object) * (1 << 64) // BINS).astype(U)
FACTORS = mix(np.arange(1, ROWS + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)
#: Row i: all bins in the order in which bin i looks for a value.
ORDER = np.argsort(mix(np.arange(BINS * BINS, dtype=U) + U(1)).reshape(BINS, BINS), axis=1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Densified one-permutation signatures of non-empty sorted sets, one row each."""
    out = np.zeros((len(sets), BINS), U)
    full = np.zeros((len(sets), BINS), bool)
    for i, s in enumerate(sets):
        at = np.searchsorted(s, EDGES)
        full[i] = at < np.r_[at[1:], len(s)]
        out[i] = s[np.minimum(at, len(s) - 1)]
    rows, bins = np.nonzero(~full)
    values = out.copy()
    for step in range(BINS):
        if not len(rows):
            break
        donor = ORDER[bins, step]
        found = full[rows, donor]
        values[rows[found], bins[found]] = out[rows[found], donor[found]]
        rows, bins = rows[~found], bins[~found]
    return values


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [s for _, s in shingle_sets(part.column(1), words)]
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), BANDS), np.int64)
                short = np.zeros((len(sets), BINS), np.uint8)
                if len(some):
                    sig = signatures([sets[i] for i in some])
                    band = (sig.reshape(len(some), BANDS, ROWS) * FACTORS).sum(axis=2, dtype=U)
                    keys[some] = mix(band + np.arange(BANDS, dtype=U)).view(np.int64)
                    short[some] = (mix(sig) >> U(56)).astype(np.uint8)
                prints = np.array(
                    [(mix(s).sum(dtype=U), mix(s ^ U(0x2545F4914F6CDD1D)).sum(dtype=U)) for s in sets], U
                ).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.array(prints[:, 0].view(np.int64) if len(sets) else [], pa.int64()),
                        pa.array(prints[:, 1].view(np.int64) if len(sets) else [], pa.int64()),
                        pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64())),
                        pa.array([r.tobytes() for r in short], pa.binary()),
                    ],
                    ["doc_id", "n", "f", "g", "bands", "sig"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [s.view(np.int64) for _, s in shingle_sets(part.column(1), words)]
                at = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["id", "s"]
                )

    return run


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * intersection >= ``percent`` * union of their shingle
    sets; ``component_id`` is the smallest id that links reach. Words are lower-cased in
    A-Z. Texts without words, NULL ones too, have 0 shingles and are linked with nothing;
    equal sets are one node, so copies make no pairs. Rows that repeat an id count as one
    document with the links of all of them; rows without an id are left out; further columns
    are ignored; an empty table gives no rows. The bands are made for a ``percent`` of 80 or
    more; less raises, as links would be lost.
    """
    if percent < 80:
        raise ValueError("the bands find pairs of 80 percent or more")
    spark = docs.sparkSession
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with Scratch(spark) as scratch:
        base = scratch.table(
            rows.mapInArrow(
                _sketch(words), "doc_id bigint, n bigint, f bigint, g bigint, bands array<bigint>, sig binary"
            ),
            "sketches",
        )
        # Equal sets are one node, named by their smallest id; their sketches are equal, too.
        print_ = ["f", "g", "n"]
        distinct = scratch.table(
            base.where("n > 0").groupBy(*print_).agg(
                F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sig").alias("sig")
            ),
            "distinct",
        )
        members = distinct.select("node", "n", F.posexplode("bands").alias("band", "key"))
        buckets = members.groupBy("band", "key").agg(
            F.min("node").alias("centre"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles")
        )
        buckets = scratch.table(buckets.where("m > 1"), "buckets")
        members = scratch.table(members.drop("n").join(buckets, ["band", "key"]), "members")
        stars = members.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
        stars = scratch.table(stars, "stars")
        linked = scratch.table(_confirm(scratch, rows, stars, words, percent), "links")
        found = components(linked)

        # Buckets that hold several components after the stars, the two-member ones aside:
        # their only pair has been looked at.
        named = members.where("m > 2").join(found, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        named = scratch.table(named.drop("centre"), "named")
        open_ = named.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        open_ = scratch.table(open_.where("x != y").select("band", "key"), "open")
        whole = None
        if not open_.isEmpty():
            unsettled = scratch.table(named.join(open_, ["band", "key"]), "unsettled")
            sets = scratch.table(_full_sets(scratch, rows, unsettled.select("node"), words), "full-sets")
            sets = sets.withColumnRenamed("id", "node").join(distinct.select("node", "sig"), "node")
            more = scratch.table(_exhaust(unsettled, sets, percent).distinct(), "more-links")
            if not more.isEmpty():
                whole = components(more).withColumnsRenamed({"node": "part", "component": "whole"})
        nodes = distinct.select("node", *print_).join(found, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        if whole is not None:
            nodes = nodes.join(whole, F.col("component") == F.col("part"), "left").withColumn(
                "component", F.coalesce("whole", "component")
            )
        out = base.join(nodes.select("component", *print_), print_, "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
        )
        return settle(out.withColumn("kept", F.col("doc_id") == F.col("component_id")))


def _full_sets(scratch: Scratch, rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Sorted shingle hashes (id, s) of the texts with these ids."""
    wanted = scratch.table(ids.toDF("id").distinct(), "wanted")
    texts = rows.withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi")
    return texts.mapInArrow(_sets(words), "id bigint, s array<bigint>")


def _confirm(scratch: Scratch, rows: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sets = scratch.table(_full_sets(scratch, rows, pairs.select("a").union(pairs.select("b")), words), "sets")
    second = pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("t")), "b")
    both = second.join(sets.select(F.col("id").alias("a"), "s"), "a")
    shared = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def _exhaust(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (a, b) that a link between members of one bucket joins.

    A bucket is cut into blocks by hash, by its members and by their shingles; block meets
    block in one task. Pairs with close signatures are confirmed there on the full sets, unless links
    found before join them already, so a task gives out a forest and never all pairs.
    """
    count = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("shingles") / CELLS))
    blocks = members.join(sets, "node").withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
    packed = blocks.groupBy("band", "key", "block").agg(
        F.collect_list(F.struct("node", "component", "sig", "s")).alias("left")
    )
    other = packed.select("band", "key", F.col("block").alias("other"), F.col("left").alias("right"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                links = _links(_members(left), _members(right), percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])

    pairs = packed.join(other, ["band", "key"]).where("block <= other").select("left", "right")
    return pairs.mapInArrow(compare, "a bigint, b bigint")


def _links(a: tuple, b: tuple, percent: int) -> list[tuple[int, int]]:
    """A forest of the components that confirmed links join, between two blocks or within one."""
    names, component = np.unique(np.r_[a[1], b[1]], return_inverse=True)
    mine, theirs = component[: len(a[1])], component[len(a[1]) :]
    parent = np.arange(len(names))
    links = []
    for i in range(len(a[0])):
        j = np.flatnonzero(parent[theirs] != parent[mine[i]])
        j = j[(a[2][i] == b[2][j]).sum(axis=1) >= CLOSE * BINS] if len(j) else j
        if not len(j):
            continue
        s, flat = a[3][i], np.concatenate([b[3][x] for x in j])
        sizes = np.array([len(b[3][x]) for x in j])
        hit = s[np.minimum(np.searchsorted(s, flat), len(s) - 1)] == flat
        shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
        for x in j[100 * shared >= percent * (len(s) + sizes - shared)]:
            old, new = parent[theirs[x]], parent[mine[i]]
            if old != new:
                parent[parent == old] = new
                links.append((int(a[1][i]), int(b[1][x])))
    return links


def _members(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    values = cell.values
    sig = np.frombuffer(b"".join(values.field("sig").to_pylist()), np.uint8).reshape(-1, BINS)
    sets = values.field("s")
    at, flat = sets.offsets.to_numpy(), sets.values.to_numpy().view(U)
    return (
        values.field("node").to_numpy(),
        values.field("component").to_numpy(),
        sig,
        [flat[x:y] for x, y in zip(at[:-1], at[1:], strict=True)],
    )
