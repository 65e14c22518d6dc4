"""Byte-pair encoding and decoding by a deterministic automaton over the tokens.

The automaton accepts exactly the token sequences that the merges produce, so a text has one
path through it. It starts with one state and an arc for each byte and takes in the merges
one after another. The gadget of a merge (u, v) -> w cuts the arc v out of the state that u
leads to, for u then v would have been merged, and adds an arc w wherever u has one, to the
state that v leads to so far. Hence a state belongs to the token that leads to it, and what
has to be kept is the arcs that are missing. w begins with u, so arcs that come and go
together are neighbours in a preorder of the tokens by their left parts, and the missing arcs of a
state are ranges of that order: a million ranges instead of 50,000 x 50,000 arcs.

Texts are cut into words as the tokenizer does; the distinct ones of a few megabytes are encoded
together, longest matches first; a look-up in the ranges tells whether the state has that arc. The tables are read on the
driver and broadcast; their size is that of the vocabulary.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: Text bytes to a batch of distinct words, words kept from earlier batches, bytes of a word that is encoded alone.
BATCH, KEPT, LONG = 4 << 20, 750_000, 256
#: Bits of a place in the preorder; room for half a million tokens.
BITS = 19

#: Fixed value: how the tokenizer's pre-splitting cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, and the byte.

    Printable Latin-1 bytes stand for themselves; the rest take the letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Automaton:
    """Labels of the arcs, a trie to match them and the missing arcs of each state.

    ``first`` and ``reach`` hold, in order, (state, place) where a range of missing arcs begins
    and the furthest (state, place) that any range so far ends at. ``root`` is the state of
    no token. ``steps`` are the trie's (node, byte) in order, step i leads to node i + 1, whose token
    is ``token[i + 1]`` or -1; ``roots`` and ``pairs`` are the
    nodes after one and two bytes. ``shorter`` is the longest other token that a token begins
    with, or -1, and ``sizes`` the bytes of each.
    """

    labels: list[bytes]
    special: dict[str, int]
    place: np.ndarray
    first: np.ndarray
    reach: np.ndarray
    root: int
    steps: np.ndarray
    token: np.ndarray
    roots: np.ndarray
    pairs: np.ndarray
    shorter: np.ndarray
    sizes: np.ndarray

    def missing(self, state: np.ndarray, arc: np.ndarray) -> np.ndarray:
        """Which states lack an arc with that label."""
        at = (state.astype(np.int64) << BITS) | self.place[arc]
        before = np.searchsorted(self.first, at, side="right") - 1
        return self.reach[before] >= at

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie's next nodes; 0 where there is none."""
        key = (node.astype(np.int64) << 8) | byte
        at = np.searchsorted(self.steps, key)
        at[at == len(self.steps)] = 0
        return np.where(self.steps[at] == key, at + 1, 0)


def compile_merges(merges: list[tuple[int, int, int]], labels: list[bytes], special: dict[str, int]) -> Automaton:
    """The automaton of ``merges`` (left, right, joined), best first; ``labels`` by token id."""
    n = len(labels)
    cut: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # own missing arcs of a token's state, by time
    longer: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # tokens that begin with this one, by time
    made: dict[int, tuple[int, int, int]] = {}  # left part, right part and time of a joined token
    when: dict[tuple[int, int], int] = {}
    never = len(merges)

    def has_arc(state: int, arc: int) -> bool:
        """Whether no cut so far took the arc, or what it grew from before it did."""
        t, until = state, never
        while True:
            y, grown = arc, never
            while True:
                time = when.get((t, y), never)
                if time < until and time <= grown:
                    return False
                if y not in made:
                    break
                y, _, grown = made[y]
            if t not in made:
                return True
            _, t, until = made[t]

    joined = {w for _, _, w in merges}
    for time, (u, v, w) in enumerate(merges):
        if any(t in joined and t not in made for t in (u, v)) or not has_arc(u, v):
            continue  # u then v never come about, so neither does w
        cut[u].append((time, v))
        longer[u].append((time, w))
        made[w] = (u, v, time)
        when[u, v] = time
    ids = set(special.values())
    singles = [t for t in range(n) if t not in joined and t not in ids]
    joined &= made.keys()

    # Preorder by left parts, older ones first: what a cut arc takes with it is a range of it.
    place, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    count = 0
    for single in singles:
        stack = [(single, False)]
        while stack:
            t, closed = stack.pop()
            if closed:
                end[t] = count - 1
                continue
            place[t] = count
            count += 1
            stack.append((t, True))
            stack.extend((w, False) for _, w in reversed(longer[t]))

    # Per token: the arcs cut after it, itself and its longer forms of that time or later.
    states, lows, highs = [], [], []
    for state in [*singles, *joined]:
        t, until = state, len(merges)
        while True:
            for time, v in cut[t]:
                if time >= until:
                    break
                states.append(state)
                lows.append(place[v])
                highs.append(place[v])
                later = bisect_left(longer[v], (time, -1))
                if later < len(longer[v]):
                    states.append(state)
                    lows.append(place[longer[v][later][1]])
                    highs.append(end[v])
            if t not in made:
                break
            _, t, until = made[t]
    states_ = np.array(states, np.int64) << BITS
    low, high = states_ | np.array(lows, np.int64), states_ | np.array(highs, np.int64)
    order = np.argsort(low, kind="stable")
    # A range before all places comes first, so every look-up finds one.
    low, reach = np.r_[-1, low[order]], np.r_[-1, np.maximum.accumulate(high[order])]
    more = np.r_[True, reach[1:] > reach[:-1]]  # others lie in an earlier range
    trie = _trie({t: labels[t] for t in [*singles, *joined]}, np.array([len(x) for x in labels], np.int64))
    return Automaton(labels, special, place, low[more], reach[more], n, **trie)


def _trie(labels: dict[int, bytes], sizes: np.ndarray) -> dict[str, np.ndarray]:
    """The tables of ``Automaton`` from ``steps`` to ``sizes``, from a trie of all labels."""
    prefixes = sorted({x[:k] for x in labels.values() for k in range(1, len(x) + 1)}, key=lambda p: (len(p), p))
    # By length, then bytes: a node's number grows with its parent's, so the steps are in order.
    nodes = {b"": 0} | {p: i + 1 for i, p in enumerate(prefixes)}
    steps = np.array([(nodes[p[:-1]] << 8) | p[-1] for p in prefixes], np.int64)
    ids = {x: t for t, x in labels.items()}
    token = np.array([ids.get(p, -1) for p in nodes], np.int32)
    roots = np.array([nodes.get(bytes([b]), 0) for b in range(256)], np.int32)
    pairs = np.array([nodes.get(bytes([a, b]), 0) for a in range(256) for b in range(256)], np.int32)
    shorter = np.full(len(sizes), -1, np.int64)
    for t, x in labels.items():
        shorter[t] = next((ids[x[:k]] for k in range(len(x) - 1, 0, -1) if x[:k] in ids), -1)
    return dict(steps=steps, token=token, roots=roots, pairs=pairs, shorter=shorter, sizes=sizes)


def load(path: str = MODEL) -> Automaton:
    """Compile a byte-level vocabulary file of the tokenizers library, on the driver."""
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    vocabulary, letters = content["model"]["vocab"], byte_letters()
    special = {x["content"]: x["id"] for x in content["added_tokens"]}
    labels = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
    for text, t in vocabulary.items():
        labels[t] = bytes(letters[c] for c in text)
    for text, t in special.items():
        labels[t] = text.encode()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
    return compile_merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], labels, special)


def _longest(tables: Automaton, data: np.ndarray, at: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The longest token that matches ``data`` from each ``at`` on and ends by ``last``."""
    best = tables.token[tables.roots[data[at]]].astype(np.int64)
    index = np.flatnonzero(at + 1 < last)
    here = at[index]
    node = tables.pairs[(data[here].astype(np.int32) << 8) | data[here + 1]]
    length = 2
    while True:
        found = node > 0
        index, node = index[found], node[found]
        if not len(index):
            return best
        token = tables.token[node]
        best[index] = np.where(token >= 0, token, best[index])
        going = at[index] + length < last[index]
        index, node = index[going], node[going]
        node = tables.step(node, data[at[index] + length])
        length += 1


def _encode_words(tables: Automaton, words: list[bytes]) -> list[bytes]:
    """Packed ids of each word: the automaton's one path through it, for all words at once.

    Every word tries the longest token that matches first, then shorter ones. A place from
    where nothing follows is left for good: one path alone leads to each place.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(lengths) - lengths
    last = start + lengths
    # Places of a word are its bytes' and the end, so a word's are numbered from start + word on.
    base = np.arange(len(words))
    reached = np.full(len(data) + len(words), -1, np.int32)
    dead = np.zeros(len(reached), bool)
    active = np.flatnonzero(lengths > 0)
    spot, state = start[active], np.full(len(active), tables.root)
    token = _longest(tables, data, spot, last[active])
    while len(active):
        goal = spot + tables.sizes[token]
        bad = dead[goal + base[active]]
        check = np.flatnonzero(~bad & (state != tables.root))
        bad[check] = tables.missing(state[check], token[check])
        # On along an arc.
        good = np.flatnonzero(~bad)
        spot[good] = goal[good]
        state[good] = token[good]
        reached[goal[good] + base[active[good]]] = token[good]
        # Another arc, or back over the last one.
        back = np.flatnonzero(bad)
        token[back] = tables.shorter[token[back]]
        while len(back := back[token[back] < 0]):
            place = spot[back] + base[active[back]]
            dead[place] = True
            gone = reached[place]
            spot[back] -= tables.sizes[gone]
            begun = spot[back] == start[active[back]]
            state[back] = np.where(begun, tables.root, reached[place - tables.sizes[gone]])
            token[back] = tables.shorter[gone]
        going = spot < last[active]
        good = good[going[good]]
        token[good] = _longest(tables, data, spot[good], last[active[good]])
        active, spot, state, token = active[going], spot[going], state[going], token[going]
    # The labels of the path, from the ends.
    index = np.flatnonzero(lengths > 0)
    place = last[index] + base[index]
    found = [(index[:0], reached[:0])]
    while len(index):
        ids = reached[place]
        found.append((index, ids))
        place -= tables.sizes[ids]
        going = place > start[index] + base[index]
        index, place = index[going], place[going]
    who = np.concatenate([w for w, _ in found[::-1]])
    packed = np.concatenate([t for _, t in found[::-1]])[np.argsort(who, kind="stable")].astype("<u4").tobytes()
    ends = (np.cumsum(np.bincount(who, minlength=len(words))) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class _Walk:
    """The same path for one long word; its look-ups are kept in dictionaries."""

    def __init__(self, tables: Automaton) -> None:
        self.tables = tables
        self.step = dict(zip(tables.steps.tolist(), count(1)))
        self.token, self.shorter, self.sizes = (x.tolist() for x in (tables.token, tables.shorter, tables.sizes))
        self.most = max(self.sizes)
        self.known: dict[int, bool] = {}

    def _missing(self, state: int, token: int) -> bool:
        key = (state << BITS) | token
        found = self.known.get(key)
        if found is None:
            if len(self.known) > KEPT:
                self.known.clear()
            found = self.known[key] = bool(self.tables.missing(np.array([state]), np.array([token]))[0])
        return found

    def _longest(self, word: bytes, at: int) -> int:
        best, node = -1, 0
        for byte in word[at : at + self.most]:
            node = self.step.get((node << 8) | byte)
            if node is None:
                break
            if self.token[node] >= 0:
                best = self.token[node]
        return best

    def encode(self, word: bytes) -> bytes:
        path: list[int] = []
        dead = bytearray(len(word) + 1)
        at, token = 0, self._longest(word, 0)
        while at < len(word):
            goal = at + self.sizes[token]
            if not dead[goal] and not (path and self._missing(path[-1], token)):
                path.append(token)
                at = goal
                token = self._longest(word, at)
                continue
            token = self.shorter[token]
            while token < 0:
                dead[at] = 1
                gone = path.pop()
                at -= self.sizes[gone]
                token = self.shorter[gone]
        return np.array(path, "<u4").tobytes()


def _plain(c: str) -> bool:
    """Whether Python's own patterns class the character as ``WORDS`` does."""
    kind = unicodedata.category(c)
    if c.isspace():
        return not "\x1c" <= c <= "\x1f"
    return kind[0] == "L" or kind == "Nd" or (kind != "Cn" and not c.isalnum())


def _splitter() -> Callable[[str], list[str]]:
    """Cuts a text into words."""
    from tokenizers import pre_tokenizers

    own = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    exact = regex.compile(WORDS).findall
    # The same for characters that are plain, several times faster: letters are what is
    # neither a digit nor an underscore among word characters.
    fast = re.compile(r" ?[^\W\d_]+| ?\d+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
    plain: dict[str, bool] = {}

    def words(text: str) -> list[str]:
        seen = set(text)
        for c in seen.difference(plain):
            plain[c] = _plain(c)
        if all(map(plain.__getitem__, seen)):
            return fast(text)
        if any(unicodedata.category(c) == "Cn" for c in seen):
            # Code points that only newer Unicode versions assign: what they are is for the library to say.
            return [text[a:b] for _, (a, b) in own.pre_tokenize_str(text)]
        return exact(text)

    return words


def encoder(tables: Automaton) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as little-endian unsigned 32-bit integers."""
    words_of = _splitter()
    marks = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(tables.special, key=len, reverse=True)) + ")")
    index: defaultdict[str, int] = defaultdict()
    packed: list[bytes] = []

    def forget() -> None:
        index.clear()
        index.default_factory = count().__next__  # a new word gets the next number
        # Special tokens go by keys that no word has: words hold no space after a letter.
        packed[:] = [np.array([t], "<u4").tobytes() for t in tables.special.values()]
        for s in tables.special:
            index[f"special {s}"]

    def split(text: str) -> list[str]:
        if not any(s in text for s in tables.special):
            return words_of(text)
        parts = marks.split(text)
        return [w for i, p in enumerate(parts) for w in ([f"special {p}"] if i % 2 else words_of(p))]

    walk: _Walk | None = None

    def run(texts: list[str]) -> list[bytes]:
        nonlocal walk
        if len(index) > KEPT or not index:
            forget()
        numbers = [list(map(index.__getitem__, split(text))) for text in texts]
        new = list(islice(reversed(index), len(index) - len(packed)))[::-1]
        words = [w.encode() for w in new]
        found = _encode_words(tables, [w if len(w) <= LONG else b"" for w in words])
        for i, w in enumerate(words):
            if len(w) > LONG:
                walk = walk or _Walk(tables)
                found[i] = walk.encode(w)
        packed.extend(found)
        return [b"".join(map(packed.__getitem__, found)) for found in numbers]

    return run


def decoder(tables: Automaton) -> Callable[[bytes], str]:
    """A function from packed ids to the text of their labels; bytes that are no UTF-8 become U+FFFD."""
    labels = dict(enumerate(tables.labels))

    def run(ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4")
        found = found[found < len(labels)].tolist()
        return b"".join(map(labels.__getitem__, found)).decode("utf-8", "replace")

    return run


def _batches(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, stop) of rows with some BATCH bytes of text together."""
    start, size = 0, 0
    for i, n in enumerate(column):
        size += len(n.as_buffer()) if n.is_valid else 0
        if size >= BATCH:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(column):
        yield start, len(column)


def broadcast(docs: DataFrame, tables: Automaton) -> Broadcast[Automaton]:
    """The tables on every executor, once; some 40 MB for 50,000 tokens, whatever the data."""
    return docs.sparkSession.sparkContext.broadcast(tables)


def _with(docs: DataFrame, *fields: StructField) -> StructType:
    return StructType([*docs.schema.fields, *fields])


def encode(docs: DataFrame, tables: Automaton, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in a binary column ``into``, four little-endian bytes each.

    Empty and NULL texts have no ids (an empty value); rows, repeated ones as well, their
    order and other columns stay; a column named ``into`` is replaced; an empty table stays
    empty. Texts of any length are encoded whole. The strings of special tokens become those
    tokens, as the tokenizers library has it.
    """
    return _run(docs, tables, text, into, None)


def encode_and_decode(
    docs: DataFrame, tables: Automaton, text: str = "text", ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """``encode`` and, from its ids, the text again in a column ``into``, by one Python worker a task."""
    return _run(docs, tables, text, ids, into)


def decode(docs: DataFrame, tables: Automaton, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in a column ``into``.

    NULL ids give an empty text, ids without a token nothing; otherwise as ``encode``.
    """
    docs = docs.drop(into)
    shared, at = broadcast(docs, tables), docs.columns.index(ids)
    names = [*docs.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = decoder(shared.value)
        for batch in batches:
            texts = [back(x or b"") for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return docs.mapInArrow(run, _with(docs, StructField(into, StringType())))


def _run(docs: DataFrame, tables: Automaton, text: str, ids: str, decoded: str | None) -> DataFrame:
    docs = docs.drop(ids, *([decoded] if decoded else []))
    shared, at = broadcast(docs, tables), docs.columns.index(text)
    names = [*docs.columns, ids, *([decoded] if decoded else [])]
    fields = [StructField(ids, BinaryType()), *([StructField(decoded, StringType())] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, back = encoder(shared.value), decoder(shared.value)
        for batch in batches:
            for start, stop in _batches(batch.column(at)):
                part = batch.slice(start, stop - start)
                packed = there([t or "" for t in part.column(at).to_pylist()])
                out = [*part.columns, pa.array(packed, pa.binary())]
                if decoded:
                    out.append(pa.array([back(x) for x in packed], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.mapInArrow(run, _with(docs, *fields))
