"""Runs of periodic text: stretches of words that repeat with a period, found and collapsed.

A suffix automaton takes in a text word by word. The suffix links of its states are a tree, kept in
link-cut form: the path from a state to the root is in segments, and each segment knows
where the strings of its states ended last. When word i is appended, the path of its prefix is
made one segment that ends at i; each segment it takes over, with last end e and longest string l,
says that the l words up to e and up to i are the same and that it was never nearer. If l reaches
i - e, these words are a square: two equal halves side by side. All squares that are not
powers of shorter ones come out so, and each is extended to its run.

The automaton only runs where a run can be. Within a run of period q and of four periods or more, every
group of words but the first ones has an equal group at most q words before it. Stretches of
words with such a near predecessor are found for all texts of a batch by one sort for
each of two group sizes and for each power of two that q may lie under; no run is outside of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

#: A run has four periods at least, and six words.
PERIODS, LEAST = 4, 6
#: Text bytes to a batch; words of a group for periods up to SHORT, and for longer ones.
BATCH = 4 << 20
PAIR, LONG, SHORT = 2, 8, 8

RUNS = ArrayType(
    StructType([StructField("start", LongType()), StructField("length", LongType()), StructField("period", LongType())])
)


def _near(ids: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places where a group of ``size`` words ends that came before in its text, how far before).

    Groups are compared by hash; a false match only makes a candidate.
    """
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    word ^= word >> np.uint64(29)
    key = doc[:n].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    for k in range(size):
        key = key * np.uint64(0x94D049BB133111EB) + word[k : k + n]
    key ^= key >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    at, before = order[same + 1], order[same]
    inside = (doc[at] == doc[at + size - 1]) & (doc[before] == doc[at])
    at, before = at[inside], before[inside]
    order = np.argsort(at)
    return at[order] + size - 1, (at - before)[order]


def candidates(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint stretches [from, to) of words that hold every run; ``doc`` says whose word each is."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for size in (PAIR, LONG):
        place, far = _near(ids, doc, size)
        top = SHORT if size == PAIR else int(far.max(initial=0))
        q = 1 if size == PAIR else 2 * SHORT
        while q < 2 * top if size == LONG else q <= top:
            # Periods from q // 2 + 1 to q: so many places in a row have an equal group within q.
            least = q // 2 + 1
            row = max(LEAST, PERIODS * least) - least - size + 1
            at = place[far <= q]
            if len(at) >= row:
                cut = np.flatnonzero((np.diff(at) != 1) | (doc[at[1:]] != doc[at[:-1]])) + 1
                first, last = np.r_[0, cut], np.r_[cut, len(at)]
                long = last - first >= row
                found.append((at[first[long]] - size + 1 - q, at[last[long] - 1] + 1))
            q *= 2
    if not found:
        return []
    begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
    begin = np.maximum(begin, np.searchsorted(doc, doc[end - 1]))
    order = np.argsort(begin, kind="stable")
    out: list[tuple[int, int]] = []
    for a, b in zip(begin[order].tolist(), end[order].tolist(), strict=True):
        if out and a <= out[-1][1] and doc[a] == doc[out[-1][1] - 1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class LinkCutAutomaton:
    """A suffix automaton whose suffix links are a link-cut tree; state 0 is nothing, state 1 the root."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}, {}]
        self.length = [-1, 0]
        self.link = [0, 0]
        self.last = 1
        # Splay trees, one for each segment; their order is the depth in the suffix links.
        self.up = [0, 0]
        self.left = [0, 0]
        self.right = [0, 0]
        self.end = [0, 0]  # of a splay tree's top: where its segment's strings ended last

    def _state(self, length: int) -> int:
        self.next.append({})
        self.length.append(length)
        for column in (self.link, self.up, self.left, self.right, self.end):
            column.append(0)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            # x under p under g; g may be a step to another segment.
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            if inner:
                gg = up[g]
                if (left[g] == p) == (left[p] == x):
                    # Zig-zig: p over g first.
                    if left[g] == p:
                        c = right[p]
                        left[g] = c
                        right[p] = g
                    else:
                        c = left[p]
                        right[g] = c
                        left[p] = g
                    if c:
                        up[c] = g
                    up[g] = p
                    if left[p] == x:
                        c = right[x]
                        left[p] = c
                        right[x] = p
                    else:
                        c = left[x]
                        right[p] = c
                        left[x] = p
                    if c:
                        up[c] = p
                    up[p] = x
                else:
                    a, b = left[x], right[x]
                    if left[p] == x:
                        # g on the left, p on the right of x.
                        right[g], left[p], left[x], right[x] = a, b, g, p
                        if a:
                            up[a] = g
                        if b:
                            up[b] = p
                    else:
                        left[g], right[p], left[x], right[x] = b, a, p, g
                        if b:
                            up[b] = g
                        if a:
                            up[a] = p
                    up[p] = up[g] = x
                top, over = g, gg
            else:
                if left[p] == x:
                    c = right[x]
                    left[p] = c
                    right[x] = p
                else:
                    c = left[x]
                    right[p] = c
                    left[x] = p
                if c:
                    up[c] = p
                up[p] = x
                top, over = p, g
            up[x] = over
            if not over:
                break
            if left[over] == top:
                left[over] = x
            elif right[over] == top:
                right[over] = x
            else:
                break
            p = over
        self.end[x] = self.end[top]

    def _split(self, q: int, length: int) -> int:
        """A copy of state ``q`` for its strings up to ``length``, between it and its link."""
        new = self._state(length)
        self.next[new] = self.next[q].copy()
        self.link[new] = self.link[q]
        self.link[q] = new
        # The copy ended last where q did, so it joins q's segment, just above q.
        self._splay(q)
        above = self.left[q]
        self.left[new], self.up[new] = above, q
        if above:
            self.up[above] = new
        self.left[q] = new
        return new

    def append(self, word: int) -> int:
        """Take in a word; the state of the text so far."""
        next_, link, length = self.next, self.link, self.length
        state = self._state(length[self.last] + 1)
        p = self.last
        while p and word not in next_[p]:
            next_[p][word] = state
            p = link[p]
        if not p:
            link[state] = 1
        else:
            q = next_[p][word]
            if length[q] != length[p] + 1:
                new = self._split(q, length[p] + 1)
                while p and next_[p].get(word) == q:
                    next_[p][word] = new
                    p = link[p]
                q = new
            link[state] = q
        self.up[state] = link[state]
        self.last = state
        return state

    def access(self, state: int, at: int) -> list[tuple[int, int]]:
        """Make the path from ``state`` to the root one segment that ends at ``at``.

        Returns (end, longest string) of the segments it was in, deepest first.
        """
        found = []
        up, right, end, length = self.up, self.right, self.end, self.length
        below, x = 0, state
        while x:
            self._splay(x)
            if end[x] and length[x]:
                found.append((end[x], length[x]))
            deeper = right[x]
            if deeper:
                end[deeper] = end[x]
            right[x] = below
            below, x = x, up[x]
        end[below] = at
        # The state itself is splayed next time; the top of the splay tree holds the end.
        return found


def find_runs(ids: list[int], begin: int = 0, end: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs that lie in ``ids[begin:end]``, by start, then period."""
    end = len(ids) if end is None else end
    automaton = LinkCutAutomaton()
    covered: dict[int, int] = {}
    out = []
    for i in range(begin, end):
        at = i - begin + 1
        state = automaton.append(ids[i])
        for before, longest in automaton.access(state, at):
            q = at - before
            if longest < q or covered.get(q, -1) >= i:
                continue
            start, stop = i - 2 * q + 1, i + 1
            while start > begin and ids[start - 1] == ids[start - 1 + q]:
                start -= 1
            while stop < end and ids[stop] == ids[stop - q]:
                stop += 1
            covered[q] = stop - 1
            if stop - start >= max(LEAST, PERIODS * q):
                out.append((start, stop - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _runs_of(texts: list[list[bytes]], index: Callable[[bytes], int]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a batch."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    ids = np.fromiter((n for t in texts for n in map(index, t)), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in candidates(ids, doc):
        d = int(doc[a])
        at = int(first[d])
        out[d].extend((a + start - at, length, q) for start, length, q in find_runs(ids[a:b].tolist()))
    return out


def _collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if not runs:
        return b" ".join(words).decode()
    gone = np.zeros(len(words), bool)
    for start, length, q in runs:
        gone[start + q : start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode()


def periodic_runs(docs: DataFrame, text: str = "text", runs: str = "runs", into: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of ``text`` and the text without what they repeat.

    ``runs`` holds (start, length, period) in words, by start, then period: maximal stretches
    of at least six words and four periods, with their smallest period. ``into`` holds the
    words, joined by one space, but those that any run contains after its first period. A
    NULL, empty or blank text has no runs and collapses to the empty text. Rows, repeated
    ones as well, and their other columns stay; columns named ``runs`` or ``into`` are
    replaced; an empty table stays empty. A text is one cell and is searched whole; a
    stretch that may hold a run takes some 700 bytes a word while it is searched.
    """
    docs = docs.drop(runs, into)
    at = docs.columns.index(text)
    names = [*docs.columns, runs, into]
    schema = StructType([*docs.schema.fields, StructField(runs, RUNS), StructField(into, StringType())])
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, size = 0, 0
        for i, n in enumerate(batch.column(at)):
            size += len(n.as_buffer()) if n.is_valid else 0
            if size >= BATCH or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                # Bytes are split at what separates words here, and at nothing else.
                words = [(t or "").encode().split() for t in part.column(at).to_pylist()]
                found = _runs_of(words, defaultdict(count().__next__).__getitem__)
                cut = [_collapse(w, r) for w, r in zip(words, found, strict=True)]
                rows = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind), pa.array(cut, pa.string())], names)

    return docs.mapInArrow(run, schema)
