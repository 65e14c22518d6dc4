"""The trie of conversation prefixes, with what sharing a prefix saves.

Conversations are sequences of turns, and a turn goes by a 128-bit digest, so a conversation
is a byte string; sorted by it, conversations that share a prefix are neighbours. A shard is a
range of them. Its trie is written as balanced parentheses, an open one when a node is
entered and a closed one when it is left. Block minima of the excess of open ones find the
close of each node, which bounds its subtree; counts of "()" up to there give its leaves, and
cumulative sums in preorder its members and savings.

Only prefixes of a shard's first and last conversation can be in other shards as well. These
two spines of each shard are merged by the same trie over the spines alone: members add up,
while a shared node's words, and itself as a child or leaf, count once. There are two
spines to a shard, so that takes one small task, whatever the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import WORD, Scratch, settle

#: Bytes of a turn's digest; parentheses to a block; ids to a piece of a list of ends.
DIGEST, BLOCK, PIECE = 16, 256, 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

INNER, HANGING, SPINE, ENDS = range(4)
NUMBERS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
PARTS = ("members", "children", "leaves", "spent", "distinct", "least", "words")
RESULT = "conv_id bigint, depth bigint, parent_conv_id bigint, " + ", ".join(f"{x} bigint" for x in NUMBERS)
SHARD = (
    f"kind int, {RESULT}, ends_sha256 string, key binary, piece string, "
    f"parts array<struct<{', '.join(f'{x}: bigint' for x in PARTS)}>>"
)


class Parentheses:
    """A balanced sequence of +1 and -1 with block minima of its excess."""

    def __init__(self, steps: np.ndarray) -> None:
        self.steps = steps
        self.excess = np.cumsum(steps, dtype=np.int64)
        blocks = -(-len(steps) // BLOCK)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(steps)] = self.excess
        self.padded = padded.reshape(-1, BLOCK)
        # A heap of minima: node i covers nodes 2i and 2i + 1, the blocks come last.
        tree = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        tree[self.leaves :] = self.padded.min(axis=1)
        level = self.leaves
        while level > 1:
            tree[level // 2 : level] = tree[level : 2 * level].reshape(-1, 2).min(axis=1)
            level //= 2
        self.tree = tree
        #: Pairs "()" that begin before each place.
        self.pairs = np.r_[0, np.cumsum((steps[:-1] > 0) & (steps[1:] < 0)), 0]
        self.pairs[-1] = self.pairs[-2] if len(steps) else 0

    def find_close(self, opened: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each of ``opened``."""
        goal = self.excess[opened] - 1
        out = np.full(len(opened), -1, np.int64)
        # In its own block.
        index = np.arange(len(opened))
        for step in range(1, BLOCK):
            at = opened[index] + step
            inside = at // BLOCK == opened[index] // BLOCK
            index, at = index[inside], at[inside]
            if not len(index):
                break
            found = self.padded.reshape(-1)[at] <= goal[index]
            out[index[found]] = at[found]
            index = index[~found]
        # The next block that goes low enough: up to the first right neighbour that does, then down.
        index = np.flatnonzero(out < 0)
        node = opened[index] // BLOCK + self.leaves
        climbing = np.arange(len(index))
        while len(climbing):
            right = (node[climbing] % 2 == 0) & (self.tree[np.minimum(node[climbing] + 1, len(self.tree) - 1)] <= goal[index[climbing]])
            node[climbing[right]] += 1
            climbing = climbing[~right]
            node[climbing] //= 2
        going = np.flatnonzero(node < self.leaves)
        while len(going):
            node[going] *= 2
            node[going] += self.tree[node[going]] > goal[index[going]]
            going = going[node[going] < self.leaves]
        for a in range(0, len(index), 4096):
            block = node[a : a + 4096] - self.leaves
            low = self.padded[block] <= goal[index[a : a + 4096], None]
            out[index[a : a + 4096]] = block * BLOCK + low.argmax(axis=1)
        return out


@dataclass
class Trie:
    """The nodes of sorted sequences in preorder, the root first."""

    depth: np.ndarray
    parent: np.ndarray
    #: The first sequence below each node, and nodes of its subtree.
    first: np.ndarray
    size: np.ndarray
    leaves: np.ndarray
    #: The node where each sequence ends, and the nodes on the way to the last one.
    ends: np.ndarray
    last_path: list[int]
    #: The nodes of a sequence that are not the previous one's: from depth ``shared`` + 1 on.
    shared: np.ndarray

    @staticmethod
    def of(keys: list[bytes]) -> Trie:
        lengths = np.array([len(k) // DIGEST for k in keys], np.int64)
        shared = np.zeros(len(keys), np.int64)
        for c in range(1, len(keys)):
            shared[c] = _shared(keys[c - 1], keys[c])
        opened = lengths - shared
        closed = np.r_[0, lengths[:-1]] - shared
        closed[0] = 0
        counts = np.r_[1, np.stack([closed, opened], axis=1).reshape(-1), lengths[-1] + 1]
        signs = np.r_[1, np.tile([-1, 1], len(keys)), -1]
        tree = Parentheses(np.repeat(signs, counts).astype(np.int8))
        places = np.flatnonzero(tree.steps > 0)
        close = tree.find_close(places)
        base = 1 + np.cumsum(opened) - opened
        owner = np.repeat(np.arange(len(keys)), opened)
        parent = np.arange(-1, len(places) - 1)
        path = [0]
        for c, (b, n, s) in enumerate(zip(base.tolist(), opened.tolist(), shared.tolist(), strict=True)):
            del path[s + 1 :]
            if n:
                parent[b] = path[s]
                path.extend(range(b, b + n))
        ends = base + opened - 1
        # Equal sequences end where the one before ended.
        new = np.maximum.accumulate(np.where((opened > 0) | (np.arange(len(keys)) == 0), np.arange(len(keys)), 0))
        return Trie(
            tree.excess[places] - 1,
            parent,
            np.r_[0, owner],
            (close - places + 1) // 2,
            tree.pairs[close] - tree.pairs[places],
            ends[new],
            path,
            shared,
        )

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums over each node's subtree."""
        total = np.r_[0, np.cumsum(values)]
        at = np.arange(len(self.size))
        return total[at + self.size] - total[at]

    def members(self, weights: np.ndarray) -> np.ndarray:
        """Per node, the weights of the sequences below it."""
        return self.below(np.bincount(self.ends, weights, len(self.size)).astype(np.int64))

    def children(self, which: np.ndarray) -> np.ndarray:
        """Per node, how many of its children are in ``which``, a mask of nodes."""
        return np.bincount(self.parent[1:][which[1:]], minlength=len(self.size))


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two sequences share from the start."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    low, high = 0, n
    while high - low > 1:
        half = (low + high) // 2
        if a[low * DIGEST : half * DIGEST] == b[low * DIGEST : half * DIGEST]:
            low = half
        else:
            high = half
    return low


def _prefix_keys(key: bytes) -> list[bytes]:
    """A name for each prefix of a sequence, by depth."""
    digest = hashlib.md5(usedforsecurity=False)
    out = [digest.digest()]
    for at in range(0, len(key), DIGEST):
        digest.update(key[at : at + DIGEST])
        out.append(digest.copy().digest())
    return out


def _columns(**given: object) -> dict[str, list]:
    """Columns of shard rows; those that are not given are NULL."""
    n = len(next(iter(given.values())))
    names = ["kind", "conv_id", "depth", "parent_conv_id", *NUMBERS, "ends_sha256", "key", "piece", "parts"]
    return {name: list(given.get(name, [None] * n)) for name in names}


def _shard(ids: np.ndarray, keys: list[bytes], words: np.ndarray) -> Iterator[dict[str, list]]:
    """Rows of one shard: whole nodes, nodes below a spine, the spines, and lists of ends on them."""
    trie = Trie.of(keys)
    n = len(trie.size)
    lengths = np.array([len(k) // DIGEST for k in keys], np.int64)
    # Words of a node: those of the conversation that opened it, at its depth.
    begin = np.cumsum(lengths) - lengths
    word = np.zeros(n, np.int64)
    word[1:] = words[begin[trie.first[1:]] + trie.depth[1:] - 1]
    members = trie.members(np.ones(len(ids)))
    bounds = np.stack([trie.first, trie.first + members], axis=1).reshape(-1)
    least = np.minimum.reduceat(np.r_[ids, ids[-1]], bounds)[::2]
    spine = np.zeros(n, bool)
    spine[np.r_[0 : lengths[0] + 1, np.array(trie.last_path)]] = True
    every = np.ones(n, bool)
    children = trie.children(every)
    saved = trie.below((members - 1) * word)

    # Who ends where: equal conversations are neighbours, by id.
    cut = np.r_[0, np.flatnonzero(np.diff(trie.ends)) + 1, len(ids)].tolist()
    texts = list(map(str, ids.tolist()))
    digests = [NO_ENDS] * n
    pieces: list[tuple[int, int, str]] = []
    for a, b in zip(cut, cut[1:], strict=False):
        node = int(trie.ends[a])
        if spine[node]:
            pieces.extend((node, int(ids[p]), ",".join(texts[p : min(p + PIECE, b)])) for p in range(a, b, PIECE))
        else:
            digests[node] = hashlib.sha256(",".join(texts[a:b]).encode()).hexdigest()

    first, last = keys[0], keys[-1]
    names: dict[int, bytes] = dict(zip(trie.last_path, _prefix_keys(last), strict=True))
    names.update(zip(range(int(lengths[0]) + 1), _prefix_keys(first), strict=True))
    hanging = ~spine & spine[trie.parent]
    for kind, which in ((INNER, np.flatnonzero(~spine & ~hanging)), (HANGING, np.flatnonzero(hanging))):
        if not len(which):
            continue
        parents = trie.parent[which]
        yield _columns(
            kind=[kind] * len(which),
            conv_id=least[which].tolist(),
            depth=trie.depth[which].tolist(),
            **({"parent_conv_id": least[parents].tolist()} if kind == INNER else {"key": [names[p] for p in parents.tolist()]}),
            n_convs=members[which].tolist(),
            n_children=children[which].tolist(),
            n_leaves=trie.leaves[which].tolist(),
            saved_tokens=saved[which].tolist(),
            ends_sha256=[digests[v] for v in which.tolist()],
        )
    parts = {
        "members": members,
        "children": trie.children(~spine),
        "leaves": trie.below(~spine & (children == 0)),
        "spent": trie.below(members * word),
        "distinct": trie.below(np.where(spine, 0, word)),
        "least": least,
        "words": word,
    }
    on_first = set(range(int(lengths[0]) + 1))
    rows = [list(range(int(lengths[0]) + 1)), trie.last_path]
    found = []
    for path, again in zip(rows, (set(), on_first), strict=True):
        # What both spines share is told once.
        found.append([
            {x: int(values[v]) if v not in again or x in ("least", "words") else 0 for x, values in parts.items()} for v in path
        ])
    yield _columns(kind=[SPINE, SPINE], key=[first, last], parts=found)
    if pieces:
        yield _columns(
            kind=[ENDS] * len(pieces),
            conv_id=[i for _, i, _ in pieces],
            key=[names[v] for v, _, _ in pieces],
            piece=[p for _, _, p in pieces],
        )


def _merged(spines: list[tuple[bytes, list[dict]]]) -> dict[str, list]:
    """The nodes of all spines, each with its parts from every shard."""
    spines = sorted(spines, key=lambda s: s[0])
    trie = Trie.of([key for key, _ in spines])
    n = len(trie.size)
    totals = {x: np.zeros(n, np.int64) for x in PARTS}
    totals["least"][:] = np.iinfo(np.int64).max
    names: list[bytes] = [b""] * n
    path: list[int] = [0]
    base = 1
    for (key, parts), shared in zip(spines, trie.shared.tolist(), strict=True):
        del path[shared + 1 :]
        more = len(key) // DIGEST - shared
        path.extend(range(base, base + more))
        base += more
        at = np.array(path)
        for x in ("members", "children", "leaves", "spent", "distinct"):
            totals[x][at] += [p[x] for p in parts]
        totals["least"][at] = np.minimum(totals["least"][at], [p["least"] for p in parts])
        totals["words"][at] = [p["words"] for p in parts]
        for v, name in zip(path[shared:], _prefix_keys(key)[shared:], strict=True):
            names[v] = name
    children = totals["children"] + trie.children(np.ones(n, bool))
    parents = [None, *totals["least"][trie.parent[1:]].tolist()]
    return {
        "key": names,
        "conv_id": totals["least"].tolist(),
        "depth": trie.depth.tolist(),
        "parent_conv_id": parents,
        "n_convs": totals["members"].tolist(),
        "n_children": children.tolist(),
        "n_leaves": (totals["leaves"] + trie.below(children == 0)).tolist(),
        "saved_tokens": (totals["spent"] - totals["distinct"] - trie.below(totals["words"])).tolist(),
    }


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(batches)
    if table is None:
        return
    words = table.column("words").combine_chunks()
    for rows in _shard(
        table.column("conv_id").to_numpy(), table.column("key").to_pylist(), words.flatten().to_numpy(zero_copy_only=False)
    ):
        yield pa.RecordBatch.from_pydict(rows, schema=_arrow(SHARD))


def _merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(batches)
    if table is None:
        return
    rows = list(zip(table.column("key").to_pylist(), table.column("parts").to_pylist(), strict=True))
    yield pa.RecordBatch.from_pydict(_merged(rows), schema=_arrow(f"key binary, {RESULT}"))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the pieces of each key, which come one after another."""
    key, digest = None, hashlib.sha256()
    schema = _arrow("key binary, ends_sha256 string")
    for batch in batches:
        done = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if k == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append({"key": key, "ends_sha256": digest.hexdigest()})
                key, digest = k, hashlib.sha256()
            digest.update(piece.encode())
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": digest.hexdigest()}], schema=schema)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a schema text of this module."""
    fields = [f.strip().split(" ", 1) for f in ddl.split(", parts array")[0].split(",")]
    schema = [(name, _TYPES[kind]) for name, kind in fields]
    if "parts array" in ddl:
        schema.append(("parts", pa.list_(pa.struct([(x, pa.int64()) for x in PARTS]))))
    return pa.schema(schema)


def sequences(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as rows (conv_id, turns): an array of (key, words) in the order of ``turn``.

    Turns are ordered NULL first, equal ones by role and text; a NULL role or text is empty;
    rows without a conversation id take no part; repeated rows are turns of their own. Only
    digests and word counts go into the array, not texts.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    found = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"), text_.alias("text")
    )
    # The length of the role tells where it ends.
    digest = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))
    place = F.expr("row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)")
    counted = found.withColumn("key", digest).withColumn("words", F.regexp_count("text", F.lit(WORD)).cast("long"))
    placed = counted.withColumn("place", place).select("conv_id", F.struct("place", "key", "words").alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words")))
    return placed.groupBy("conv_id").agg(turns.alias("turns"))


def share_openings(found: DataFrame, openings: DataFrame, base: Column, length: Column) -> DataFrame:
    """``sequences`` whose first ``length`` turns are those of the conversation ``base`` in ``openings``.

    All turns of a shorter one, none of a missing one; after them come the conversation's own
    turns from there on. ``openings`` are sequences too, cut to the longest ``length``, say.
    """
    given = found.withColumn("_base", base).withColumn("_length", length.cast("int"))
    openings = openings.select(F.col("conv_id").alias("_base"), F.col("turns").alias("_opening"))
    opening = F.coalesce(F.slice("_opening", F.lit(1), F.col("_length")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("_length") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return given.join(openings, "_base", "left").select("conv_id", F.concat(opening, own).alias("turns"))


def prefix_trie(found: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the ``sequences``, the empty one included.

    ``conv_id`` is the smallest conversation that begins with it, ``parent_conv_id`` that of the
    prefix one turn shorter (NULL for the root), ``n_convs`` how many begin with it, ``n_children``
    and ``n_leaves`` its extensions by one turn and those without one, itself included;
    ``saved_tokens`` sums, over it and its extensions, the words of the last turn for each
    conversation but one; ``ends_sha256`` hashes the ids, ascending and joined by commas, of the
    conversations that end with it.

    Equal conversations and ties are members of the same nodes; a conversation without
    turns ends at the root; an empty table has no rows. Conversations are split over shards
    by their turns and id, so neither a prefix nor a conversation that a third of them
    share lands in one task; the ids of such a prefix are hashed as a stream.
    """
    spark = found.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Digests joined as hexadecimal text: bytes have no linear-time join.
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    with Scratch(spark) as scratch:
        # Kept first: finding the ranges reads it once more.
        flat = scratch.table(found.select("conv_id", key.alias("key"), F.col("turns.words").alias("words")), "sequences")
        ranged = flat.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
        rows = scratch.table(ranged.mapInArrow(_build_shards, SHARD), "shards")
        spines = rows.where(F.col("kind") == SPINE).select("key", "parts").repartition(1)
        merged = scratch.table(spines.mapInArrow(_merge_spines, f"key binary, {RESULT}"), "spines")
        ends = rows.where(F.col("kind") == ENDS).select("key", "conv_id", "piece")
        ends = ends.repartition("key").sortWithinPartitions("key", "conv_id")
        hashes = ends.mapInArrow(_hash_ends, "key binary, ends_sha256 string")
        columns = ["conv_id", "depth", "parent_conv_id", *NUMBERS]
        shared = merged.join(hashes, "key", "left").select(
            *columns, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
        )
        parents = merged.select("key", F.col("conv_id").alias("_parent"))
        hanging = rows.where(F.col("kind") == HANGING).drop("parent_conv_id").join(parents, "key")
        hanging = hanging.withColumnRenamed("_parent", "parent_conv_id").select(*columns, "ends_sha256")
        inner = rows.where(F.col("kind") == INNER).select(*columns, "ends_sha256")
        return settle(inner.unionByName(hanging).unionByName(shared))
