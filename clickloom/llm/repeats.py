"""Substring dedup by longest previous factors: bytes that repeat an earlier document's bytes go.

The longest previous factor of a place is the longest string from there on that also starts
in a smaller document; a byte goes if a factor of LENGTH bytes or more covers it. Only
suffixes that can share as much must meet, so no suffix array of all the text is sorted. A
window (LENGTH bytes) is known by the least hash of its GRAM-byte grams; a
maximal run of windows with the same least hash is one piece, so most pieces hold many
windows. The work, over chunks of whole documents:

1. Every chunk gives out the hashes of its pieces, a few bytes each, dealt by hash; those
   that come from two documents are told back to their chunks. The rest of the text, as a
   rule most of it, is done with.
2. Every chunk gives out its distinct pieces with such hashes, each with the smallest
   document id that holds it in the chunk.
3. Per deal the suffixes of all pieces are sorted and get their common prefixes with their
   neighbours. The previous and the next one with a smaller document, in that order, give each
   its longest previous factor; where that reaches LENGTH, the smaller document is told back.
4. Every chunk marks the windows that a smaller document id holds, and cuts their bytes.

A hash that comes from very many chunks (the edge of a passage that a third of all
documents share) has its windows dealt one by one by their own content instead of by
piece, so no task gets more than its share. Hashes only choose what meets; bytes decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Scratch
from clickloom.llm.shingles import BASE, PIECE, U, mix, powers, text_bytes

LENGTH, GRAM = 50, 24
GRAMS = LENGTH - GRAM + 1
#: Bytes of text to a chunk; hashes, and bytes of pieces, to a deal.
CHUNK, HASHES, PIECES = 4 << 20, 1 << 20, 6 << 20
#: A hash from more chunks than this has its windows dealt one by one.
HOT = 2000
BYTE = mix(np.arange(1, 257, dtype=U) * BASE)
LOW = U((1 << 40) - 1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed into rows of about CHUNK bytes; a chunk's number is unique."""
    ids: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    number, held = TaskContext.get().partitionId() << 32, 0

    def row() -> pa.RecordBatch:
        values = [np.concatenate(c).tobytes() for c in (ids, sizes, parts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *[pa.array([v], pa.binary()) for v in values]], ["chunk", "ids", "sizes", "data"]
        )

    for batch in batches:
        data, at = text_bytes(batch.column(1))
        doc = batch.column(0).to_numpy()
        first = 0
        while first < len(doc):
            last = int(np.searchsorted(at, at[first] + CHUNK - held, "right")) - 1
            last = min(max(last, first + 1), len(doc))
            ids.append(doc[first:last])
            sizes.append(np.diff(at[first : last + 1]))
            parts.append(data[at[first] : at[last]].copy())
            held += len(parts[-1])
            first = last
            if held >= CHUNK // 2 and first < len(doc) or held >= CHUNK:
                yield row()
                ids, parts, sizes, held = [], [], [], 0
                number += 1
    if ids:
        yield row()


class _Pieces:
    """The pieces of a chunk: start, number of windows, least hash, document; content hashes."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray) -> None:
        ends = np.cumsum(sizes)
        begins = ends - sizes
        n = len(data)
        inside = np.zeros(n + 1, np.int8)
        long = sizes >= LENGTH
        inside[begins[long]] += 1
        inside[ends[long] - LENGTH + 1] -= 1
        valid = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        start, count, least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, U)]
        for a in range(0, max(0, n - LENGTH + 1), PIECE):
            part = data[a : a + PIECE + LENGTH - 1]
            windows = len(part) - LENGTH + 1
            up, down = powers(len(part) + 1)
            total = np.r_[U(0), np.cumsum(BYTE[part] * up[:-1], dtype=U)]
            m = mix((total[GRAM:] - total[:-GRAM]) * down[: len(part) - GRAM + 1])
            wide = 1
            while wide * 2 <= GRAMS:
                m = np.minimum(m[:-wide], m[wide:])
                wide *= 2
            rest = GRAMS - wide
            m = np.minimum(m[: len(m) - rest], m[rest:]) if rest else m
            ok = valid[a : a + windows]
            edge = np.ones(windows, bool)
            edge[1:] = (m[1:] != m[:-1]) | ~ok[:-1]
            first = np.flatnonzero(ok & edge)
            stop = np.ones(windows, bool)
            stop[:-1] = edge[1:] | ~ok[1:]
            last = np.flatnonzero(ok & stop)
            start.append(first + a)
            count.append(last - first + 1)
            least.append(m[first])
        self.data = data
        self.start, self.count, self.least = map(np.concatenate, (start, count, least))
        self.doc = np.searchsorted(ends, self.start, "right")
        self.ids = mix(self.least ^ U(0x1F83D9ABFB41BD6B))

    def choose(self, told: np.ndarray, hot: np.ndarray, deals: int) -> None:
        """Keep the pieces with a told hash, cut those with a hot one into windows."""
        place = np.searchsorted(told, self.key(deals))
        place = np.minimum(place, max(len(told) - 1, 0))
        some = (told[place] == self.key(deals)) if len(told) else np.zeros(len(self.start), bool)
        hot = hot[place] & some if len(told) else some
        cold = np.flatnonzero(some & ~hot)
        warm = np.flatnonzero(hot)
        n = self.count[warm]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.start = np.r_[self.start[cold], np.repeat(self.start[warm], n) + step]
        self.count = np.r_[self.count[cold], np.ones(len(step), np.int64)]
        self.doc = np.r_[self.doc[cold], np.repeat(self.doc[warm], n)]
        alone = np.arange(len(self.start)) >= len(cold)
        self.least = np.r_[self.least[cold], np.repeat(self.least[warm], n)]
        self.content = _content(self.data, self.start, self.count + LENGTH - 1)
        #: Pieces meet by their least hash, single windows of hot ones by their content.
        self.deal = mix(np.where(alone, self.content, self.least))

    def key(self, deals: int) -> np.ndarray:
        """Hash as the first step deals it: number of the deal, and 40 bits."""
        return ((self.ids >> U(40)) % U(deals) << U(40) | (self.ids & LOW)).astype(np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for each different piece, and one position of each number."""
        order = np.lexsort((self.content, self.least))
        a, b = self.content[order], self.least[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(order)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return number, order[new]


def _content(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, a bounded number of bytes at a time."""
    out = np.zeros(len(start), U)
    order = np.argsort(start, kind="stable")
    at = 0
    while at < len(order):
        a = int(start[order[at]])
        stop = int(np.searchsorted(start[order], a + PIECE, "left"))
        rows = order[at:stop]
        end = int((start[rows] + size[rows]).max())
        up, down = powers(end - a + 1)
        total = np.r_[U(0), np.cumsum(BYTE[data[a:end]] * up[:-1], dtype=U)]
        s = start[rows] - a
        out[rows] = mix((total[s + size[rows]] - total[s]) * down[s] + size[rows].astype(U))
        at = stop
    return out


def _of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, sizes and bytes of a chunk."""
    return (
        np.frombuffer(row["ids"], np.int64),
        np.frombuffer(row["sizes"], np.int64),
        np.frombuffer(row["data"], np.uint8),
    )


def _grouped(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each different value of ``key`` with its positions."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    for a, b in zip(edges, [*edges[1:], len(key)], strict=True):
        yield int(key[order[a]]), order[a:b]


def _give_hashes(deals: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, sizes, data = _of(row)
                pieces = _Pieces(data, sizes)
                x, doc = pieces.ids, ids[pieces.doc]
                if not len(x):
                    continue
                order = np.argsort(x, kind="stable")
                first = np.flatnonzero(np.r_[True, x[order][1:] != x[order][:-1]])
                least = np.minimum.reduceat(doc[order], first)
                most = np.maximum.reduceat(doc[order], first)
                one = x[order][first]
                # A hash of two documents here is given out twice.
                given = np.r_[one, one[least != most]]
                parts = [
                    (deal, given[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
                    for deal, at in _grouped((given >> U(40)) % U(deals))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[0] for p in parts], pa.int64()),
                        pa.array([row["chunk"]] * len(parts), pa.int64()),
                        pa.array([p[1] for p in parts], pa.binary()),
                    ],
                    ["deal", "chunk", "low"],
                )

    return run


def _tell_hashes(table: pa.Table) -> pa.Table:
    """Of one deal: the hashes given out at least twice, for each chunk."""
    deal = table.column("deal")[0].as_py()
    chunk = table.column("chunk").to_numpy()
    lows = table.column("low").to_pylist()
    size = np.array([len(b) // 5 for b in lows])
    low = np.zeros((size.sum(), 8), np.uint8)
    low[:, :5] = np.frombuffer(b"".join(lows), np.uint8).reshape(-1, 5)
    low = low.view("<u8").ravel()
    order = np.argsort(low, kind="stable")
    first = np.flatnonzero(np.r_[True, low[order][1:] != low[order][:-1]])
    n = np.diff(np.r_[first, len(low)])
    many = np.repeat(n, n)
    some = many >= 2
    at, hot = order[some], many[some] > HOT
    key = (low[at] | U(deal << 40)).astype(np.int64)
    of = np.repeat(np.arange(len(lows)), size)[at]
    rows = [(int(chunk[c]), key[p].tobytes(), hot[p].tobytes(), len(p)) for c, p in _grouped(of)]
    return pa.table(
        {
            "chunk": pa.array([r[0] for r in rows], pa.int64()),
            "told": pa.array([r[1] for r in rows], pa.binary()),
            "hot": pa.array([r[2] for r in rows], pa.binary()),
            "n": pa.array([r[3] for r in rows], pa.int64()),
        }
    )


def _told(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    told = np.frombuffer(b"".join(b or b"" for b in table.column("told").to_pylist()), np.int64)
    hot = np.frombuffer(b"".join(b or b"" for b in table.column("hot").to_pylist()), bool)
    told, at = np.unique(told, return_index=True)
    return told, hot[at]


EMPTY_PIECES = pa.schema(
    [("deal", pa.int64()), ("chunk", pa.int64()), ("number", pa.binary()), ("size", pa.binary()), ("doc", pa.binary()), ("data", pa.binary())]
)


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return data[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]


def _give_pieces(deals: int, piece_deals: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        told, hot = _told(right)
        for row in left.to_pylist() if len(told) else ():
            ids, sizes, data = _of(row)
            pieces = _Pieces(data, sizes)
            pieces.choose(told, hot, deals)
            if not len(pieces.start):
                continue
            number, one = pieces.distinct()
            doc = np.full(len(one), np.iinfo(np.int64).max)
            np.minimum.at(doc, number, ids[pieces.doc])
            size = pieces.count[one] + LENGTH - 1
            for deal, at in _grouped(pieces.deal[one] % U(piece_deals)):
                text = _gather(data, pieces.start[one[at]], size[at])
                rows.append(
                    (deal, row["chunk"], at.astype(np.int32).tobytes(), size[at].astype(np.int32).tobytes(), doc[at].tobytes(), text.tobytes())
                )
        return pa.table([list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6, schema=EMPTY_PIECES)

    return run


EMPTY_FOUND = pa.schema([("chunk", pa.int64()), ("number", pa.binary()), ("runs", pa.binary()), ("size", pa.binary()), ("doc", pa.binary())])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number that sorts like them."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    word = np.zeros(len(data), U)
    for i in range(8):
        word = word << U(8) | padded[i : i + len(data)].astype(U)
    return word


STEPS = [*range(0, LENGTH - 7, 8), LENGTH - 8]


def suffix_order(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``at`` in order of their first LENGTH bytes, and what each shares with the one before.

    The common prefix is counted in bytes, up to LENGTH; the first has none.
    """
    word = _words(data)
    order = np.lexsort([word[at + s] for s in reversed(STEPS)])
    shared = np.zeros(len(at), np.int64)
    same = np.arange(1, len(at))
    for s in STEPS:
        w = word[at[order] + s]
        differ = w[same] ^ w[same - 1]
        other = differ != 0
        # Equal leading bytes of the first words that differ.
        bits = np.frexp((differ[other] >> U(8)).astype(np.float64))[1]
        shared[same[other]] = s + np.where(differ[other] >> U(8) == 0, 7, (56 - bits) // 8)
        same = same[~other]
    shared[same] = LENGTH
    return order, shared


def _smaller(doc: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the nearest one before it with a smaller document, and what they share.

    Pointers to the one before are doubled over suffixes that are no smaller, all at once; -1
    and 0 where there is none that shares LENGTH bytes.
    """
    to = np.arange(-1, len(doc) - 1)
    common = shared.copy()
    open_ = np.flatnonzero((common >= LENGTH) & (to >= 0))
    to[common < LENGTH] = -1
    while len(open_):
        open_ = open_[doc[to[open_]] >= doc[open_]]
        over = to[open_]
        common[open_] = np.minimum(common[open_], common[over])
        to[open_] = to[over]
        open_ = open_[to[open_] >= 0]
    return to, np.where(to >= 0, common, 0)


def longest_previous(data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous factors of the suffixes at ``at``, as far as they reach LENGTH.

    The suffix that shares the most with one and starts in a smaller document is the nearest
    such one before or after it in suffix order. Returns the factor's length (LENGTH,
    or 0 where it is shorter) and the smaller document, or the suffix's own.
    """
    order, shared = suffix_order(data, at)
    mine = doc[order]
    before, left = _smaller(mine, shared)
    # What follows is what comes before in the reversed order.
    after, right = _smaller(mine[::-1], np.r_[0, shared[1:][::-1]])
    after, right = len(at) - 1 - after[::-1], right[::-1]
    factor = np.maximum(left, right)
    least = np.where(left > 0, mine[before], mine)
    least = np.minimum(least, np.where(right > 0, mine[np.minimum(after, len(at) - 1)], mine))
    lengths, found = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    lengths[order], found[order] = factor, least
    return lengths, found


def _tell_pieces(table: pa.Table) -> pa.Table:
    """Of one deal: for each piece of each chunk the smallest documents of its windows, as runs."""
    rows = table.to_pylist()
    number = [np.frombuffer(r["number"], np.int32) for r in rows]
    size = np.concatenate([np.frombuffer(r["size"], np.int32) for r in rows]).astype(np.int64)
    doc = np.concatenate([np.frombuffer(r["doc"], np.int64) for r in rows])
    data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
    start = np.cumsum(size) - size
    content = _content(data, start, size)
    # The same piece of several chunks is looked at once, with the smallest document.
    _, one, same = np.unique(np.stack([content, size.astype(U)]), axis=1, return_index=True, return_inverse=True)
    same = same.ravel()
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, same, doc)
    n = size[one] - LENGTH + 1
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    _, found = longest_previous(data, np.repeat(start[one], n) + step, np.repeat(least, n))
    # Runs of windows with one smallest document.
    edge = np.r_[True, (found[1:] != found[:-1])][: len(found)] | (step == 0)
    at = np.flatnonzero(edge)
    length = np.diff(np.r_[at, len(found)])
    owner = np.repeat(np.arange(len(one)), n)[at]
    runs = np.bincount(owner, minlength=len(one))
    first_run = np.cumsum(runs) - runs
    # Nothing is told where the chunk's own smallest document is the smallest of all.
    own = (runs[same] == 1) & (found[at][first_run[same]] == doc)
    out, begin = [], 0
    for r, numbers in zip(rows, number, strict=True):
        tell = np.flatnonzero(~own[begin : begin + len(numbers)])
        of = same[begin + tell]
        k = runs[of]
        pick = np.arange(k.sum()) + np.repeat(first_run[of] - (np.cumsum(k) - k), k)
        out.append(
            (r["chunk"], numbers[tell].tobytes(), k.astype(np.int32).tobytes(), length[pick].astype(np.int32).tobytes(), found[at][pick].tobytes())
        )
        begin += len(numbers)
    return pa.table([list(c) for c in zip(*out, strict=True)], schema=EMPTY_FOUND)


KEPT = "doc_id bigint, n_bytes bigint, removed array<struct<start:bigint,length:bigint>>, kept binary"


def _cut(deals: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told, hot = _told(right)
        ids, sizes, removed, kept = [], [], [], []
        for row in left.to_pylist():
            doc, size, data = _of(row)
            mark = np.zeros(len(data) + 1, np.int32)
            if len(told):
                pieces = _Pieces(data, size)
                pieces.choose(told, hot, deals)
                _mark(mark, pieces, doc, right)
            gone = np.cumsum(mark[:-1]) > 0
            end = np.cumsum(size)
            for i in range(len(doc)):
                a, b = int(end[i] - size[i]), int(end[i])
                g = np.r_[False, gone[a:b], False]
                edges = np.flatnonzero(g[1:] != g[:-1]).reshape(-1, 2)
                removed.append([{"start": int(s), "length": int(e - s)} for s, e in edges])
                kept.append(data[a:b][~gone[a:b]].tobytes())
            ids.append(doc)
            sizes.append(size)
        return pa.table(
            {
                "doc_id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
                "n_bytes": pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                "removed": pa.array(removed, kind),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def _mark(mark: np.ndarray, pieces: _Pieces, doc: np.ndarray, right: pa.Table) -> None:
    """Mark where removed stretches begin (+1) and end (-1)."""
    if not len(pieces.start):
        return
    number, one = pieces.distinct()
    mine = doc[pieces.doc]
    least = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(least, number, mine)
    told = [r for r in right.select(["number", "runs", "size", "doc"]).to_pylist() if r["number"]]

    def all_of(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(r[name] for r in told), kind)

    numbers, runs = all_of("number", np.int32), all_of("runs", np.int32).astype(np.int64)
    length, first = all_of("size", np.int32).astype(np.int64), all_of("doc", np.int64)
    # Runs of every distinct piece, in order of its number: told ones, or one of its own.
    own = np.ones(len(one), bool)
    own[numbers] = False
    owner = np.r_[np.repeat(numbers, runs), np.flatnonzero(own)]
    length = np.r_[length, pieces.count[one[own]]]
    first = np.r_[first, least[own]]
    order = np.argsort(owner, kind="stable")
    owner, length, first = owner[order], length[order], first[order]
    k = np.bincount(owner, minlength=len(one))
    at = np.cumsum(k) - k
    upto = np.cumsum(length) - length
    offset = upto - upto[at[owner]]
    # Every place of a piece takes its runs; those of a smaller document are cut.
    n = k[number]
    pick = np.arange(n.sum()) + np.repeat(at[number] - (np.cumsum(n) - n), n)
    begin = np.repeat(pieces.start, n) + offset[pick]
    cut = first[pick] < np.repeat(mine, n)
    np.add.at(mark, begin[cut], 1)
    np.add.at(mark, begin[cut] + length[pick][cut] + LENGTH - 1, -1)


def remove_repeats(docs: DataFrame, scratch: Scratch, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, removed (spans in bytes), kept (bytes).

    Every byte goes that a LENGTH-byte string covers which also starts in a document with
    a smaller id; strings are judged on the input and never cross documents. NULL texts
    are empty; rows that repeat an id do not count as earlier for one another; rows
    without an id are left out; further columns are ignored; an empty table gives no
    rows. A document is one cell and must fit a task. The result reads tables of
    ``scratch`` and must be used while that is open.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(doc).isNotNull()).select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    # Chunks are stored in buckets, so joining what is told back does not move the text.
    chunks = scratch.bucketed(
        rows.mapInArrow(_chunks, "chunk bigint, ids binary, sizes binary, data binary"), "chunk", "chunks"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = chunks.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    deals = max(parts, int(size / (GRAMS / 2 + 0.5) / HASHES) + 1)
    given = chunks.mapInArrow(_give_hashes(deals), "deal bigint, chunk bigint, low binary")
    told = scratch.table(
        given.groupBy("deal").applyInArrow(_tell_hashes, "chunk bigint, told binary, hot binary, n bigint"), "told"
    )
    n = told.agg(F.sum("n")).first()[0] or 0
    piece_deals = max(parts, int(n * (LENGTH + GRAMS / 2) / PIECES) + 1)
    pieces = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        _give_pieces(deals, piece_deals),
        "deal bigint, chunk bigint, number binary, size binary, doc binary, data binary",
    )
    found = scratch.table(
        pieces.groupBy("deal").applyInArrow(
            _tell_pieces, "chunk bigint, number binary, runs binary, size binary, doc binary"
        ),
        "found",
    )
    back = told.drop("n").unionByName(found, allowMissingColumns=True)
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(_cut(deals), KEPT)
