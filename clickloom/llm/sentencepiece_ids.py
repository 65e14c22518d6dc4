"""SentencePiece encoding and decoding over a lattice of the distinct words of a batch.

Words (a run of spaces and what follows up to the next space) are brought down to the
distinct ones of an Arrow batch. All substrings of a word up to the longest piece are
looked up in the piece table at once, which gives its lattice of edges; the edges are then
folded to the best segmentation for all words of a length together. For a unigram model
the fold is Viterbi, the path of the highest total score. The ids of a merge (BPE) model
are no such path: there the fold joins, as the model prescribes, the neighbours with the
best piece first, the leftmost of equals. Characters without a piece become byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from clickloom.llm.repeats import BYTE
from clickloom.llm.shingles import U, mix, powers, spans, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Text bytes to a batch of distinct words, lattice cells to a fold, longest word folded in bulk.
BATCH, CELLS, BULK = 1 << 20, 500_000, 40
SLOTS = 19
NONE = np.iinfo(np.int32).max
SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    """The piece table: text of each id with plain spaces, its score, and hashed slots for look-ups."""

    texts: list[bytes]
    scores: np.ndarray
    merges: bool
    byte_ids: np.ndarray
    unknown: int
    longest: int
    hashes: np.ndarray
    ids: np.ndarray
    slots: np.ndarray

    @staticmethod
    def load(path: str = MODEL) -> Pieces:
        """Read a model file, on the driver."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as f:
            content = f.read()
        model = proto.ModelProto()
        model.ParseFromString(content)
        sp = sentencepiece.SentencePieceProcessor(model_proto=content)
        texts, normal, byte_ids = [], [], np.full(256, sp.unk_id(), np.int32)
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                texts.append(bytes([int(piece[3:5], 16)]))
                byte_ids[int(piece[3:5], 16)] = i
            elif sp.is_control(i) or sp.is_unknown(i):
                texts.append("⁇".join("  ").encode() if sp.is_unknown(i) else b"")
            else:
                texts.append(piece.replace(SPACE, " ").encode())
                if not sp.is_unused(i):
                    normal.append(i)
        keys = np.array([_hash_one(texts[i]) for i in normal], U)
        order = np.argsort(keys)
        keys, ids = keys[order], np.array(normal, np.int32)[order]
        # A slot holds where the hashes with its leading bits begin.
        slots = np.searchsorted(keys, np.arange((1 << SLOTS) + 1, dtype=U) << U(64 - SLOTS)).astype(np.int32)
        slots[-1] = len(keys)
        return Pieces(
            texts,
            np.array([sp.get_score(i) for i in range(len(texts))]),
            model.trainer_spec.model_type == model.trainer_spec.BPE,
            byte_ids,
            sp.unk_id(),
            max(len(texts[i].decode()) for i in normal),
            keys,
            ids,
            slots,
        )

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, NONE where there is none."""
        slot = (hashes >> U(64 - SLOTS)).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        out = np.full(len(hashes), NONE, np.int32)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            hit = self.hashes[at] == hashes[left]
            out[left[hit]] = self.ids[at[hit]]
            on = ~hit & (at + 1 < end)
            left, at, end = left[on], at[on] + 1, end[on]
        return out


def _hash_one(text: bytes) -> np.uint64:
    data = np.frombuffer(text, np.uint8)
    up, _ = powers(len(data) + 1)
    return mix(np.array([(BYTE[data] * up[:-1]).sum(dtype=U)], U))[0]


def _take(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ranges of ``values``, one after another."""
    return values[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]


def _encode_words(data: np.ndarray, at: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words ``data[at[i]:at[i + 1]]``, flat, and how many each has."""
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    begin = np.searchsorted(leads, at)
    chars = np.diff(begin)
    leads = np.r_[leads, len(data)]
    up, down = powers(len(data) + 1)
    total = np.r_[U(0), np.cumsum(BYTE[data] * up[:-1], dtype=U)]
    words, ids = [], []
    for n in np.unique(chars):
        of = np.flatnonzero(chars == n)
        if n > BULK:
            for w in of:
                found = _fold_long(bytes(data[at[w] : at[w + 1]]).decode(), pieces)
                ids.append(np.array(found, np.int32))
                words.append(np.full(len(found), w))
            continue
        wide = min(int(n), pieces.longest)
        step = max(1, CELLS // int(n * wide))
        for some in (of[i : i + step] for i in range(0, len(of), step)):
            place = leads[begin[some][:, None] + np.arange(n + 1)]
            lattice = _lattice(place, total, down, wide, pieces)
            fold = _fold_merges if pieces.merges else _fold_viterbi
            word, start, size = fold(lattice, pieces)
            found = lattice[word, start, size - 1]
            # A character without a piece: its bytes.
            lost = found == NONE
            n_bytes = np.where(lost, place[word, start + size] - place[word, start], 1)
            flat = np.repeat(found, n_bytes)
            raw = _take(data, place[word[lost], start[lost]], n_bytes[lost])
            flat[np.repeat(lost, n_bytes)] = pieces.byte_ids[raw]
            ids.append(flat)
            words.append(some[np.repeat(word, n_bytes)])
    word = np.concatenate(words) if words else np.zeros(0, np.int64)
    order = np.argsort(word, kind="stable")
    flat = np.concatenate(ids)[order] if ids else np.zeros(0, np.int32)
    return flat, np.bincount(word, minlength=len(chars))


def _lattice(place: np.ndarray, total: np.ndarray, down: np.ndarray, wide: int, pieces: Pieces) -> np.ndarray:
    """Piece ids [word, first character, characters - 1] of all substrings up to ``wide`` characters."""
    m, n = place.shape[0], place.shape[1] - 1
    out = np.full((m, n, wide), NONE, np.int32)
    at = total[place]
    back = down[place]
    for size in range(1, wide + 1):
        hashes = mix((at[:, size:] - at[:, :-size]) * back[:, : n - size + 1])
        out[:, : n - size + 1, size - 1] = pieces.find(hashes.ravel()).reshape(m, -1)
    return out


def _fold_merges(lattice: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, first character, characters) of the symbols left when no neighbours join."""
    m, n, wide = lattice.shape
    rank = np.empty(len(pieces.scores) + 1, np.int32)
    rank[:-1] = np.unique(-pieces.scores, return_inverse=True)[1]
    rank[-1] = NONE
    ranks = rank[np.minimum(lattice, len(pieces.scores))]
    # end[w, i]: where the symbol that begins at i ends; 0 where none begins. Column n ends all.
    end = np.tile(np.r_[np.arange(1, n + 1), 0], (m, 1))
    live = np.arange(m)
    final = end.copy()
    while len(live):
        e = end[:, :n]
        far = np.take_along_axis(end, np.where(e > 0, e, n), 1)
        size = far - np.arange(n)
        can = (e > 0) & (far > 0) & (size <= wide)
        row = live[:, None]
        r = np.where(can, ranks[row, np.arange(n), np.where(can, size - 1, 0)], NONE)
        best = r.argmin(axis=1)
        some = np.arange(len(live))
        go = r[some, best] < NONE
        final[live[~go]] = end[~go]
        some, best = some[go], best[go]
        middle = end[some, best]
        end[some, best] = far[some, best]
        end[some, middle] = 0
        live, end = live[go], end[go]
    word, start = np.nonzero(final[:, :n])
    return word, start, final[word, start] - start


def _fold_viterbi(lattice: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, first character, characters) of the path with the highest total score.

    A character without a piece is an edge scored 10 below the lowest piece; equal totals
    take the shorter last edge.
    """
    m, n, wide = lattice.shape
    low = pieces.scores.min() - 10
    best = np.full((m, n + 1), -np.inf)
    best[:, 0] = 0
    last = np.ones((m, n + 1), np.int64)
    for end in range(1, n + 1):
        for size in range(1, min(wide, end) + 1):
            id_ = lattice[:, end - size, size - 1]
            score = np.where(id_ < NONE, pieces.scores[np.minimum(id_, len(pieces.scores) - 1)], low if size == 1 else -np.inf)
            score = best[:, end - size] + score
            better = score > best[:, end]
            best[better, end] = score[better]
            last[better, end] = size
    word, start, length = [], [], []
    at = np.full(m, n)
    while (at > 0).any():
        some = np.flatnonzero(at > 0)
        size = last[some, at[some]]
        at[some] -= size
        word.append(some)
        start.append(at[some].copy())
        length.append(size)
    word, start, length = map(np.concatenate, (word, start, length))
    order = np.lexsort((start, word))
    return word[order], start[order], length[order]


def _fold_long(word: str, pieces: Pieces) -> list[int]:
    """Ids of one long word; the folds above with a queue of joins, or a dictionary of edges."""
    import heapq

    size = np.array([len(c.encode()) for c in word])
    data = np.frombuffer(word.encode(), np.uint8)
    place = np.r_[0, np.cumsum(size)]
    up, down = powers(len(data) + 1)
    total = np.r_[U(0), np.cumsum(BYTE[data] * up[:-1], dtype=U)]
    n = len(word)
    edges = [
        pieces.find(mix((total[place[k:]] - total[place[:-k]]) * down[place[:-k]])) for k in range(1, min(n, pieces.longest) + 1)
    ]

    def edge(a: int, b: int) -> int:
        return int(edges[b - a - 1][a]) if b - a <= len(edges) else NONE

    symbols: list[tuple[int, int]] = []
    if pieces.merges:
        right = list(range(1, n + 1))
        left = list(range(-1, n))
        alive = [True] * n
        queue: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            b = right[a]
            if b < n and (i := edge(a, right[b])) != NONE:
                heapq.heappush(queue, (-pieces.scores[i], a, right[b]))

        for a in range(n):
            offer(a)
        while queue:
            _, a, end = heapq.heappop(queue)
            if not alive[a] or right[a] >= n or right[right[a]] != end:
                continue
            alive[right[a]] = False
            right[a] = end
            if end < n:
                left[end] = a
                offer(a)
            if left[a] >= 0:
                offer(left[a])
        symbols = [(a, right[a]) for a in range(n) if alive[a]]
    else:
        low = pieces.scores.min() - 10
        best, last = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for b in range(1, n + 1):
            for a in range(b - 1, max(-1, b - len(edges) - 1), -1):
                i = edge(a, b)
                score = best[a] + (pieces.scores[i] if i != NONE else low if b - a == 1 else -np.inf)
                if score > best[b]:
                    best[b], last[b] = score, a
        b = n
        while b:
            symbols.append((last[b], b))
            b = last[b]
        symbols.reverse()
    out: list[int] = []
    for a, b in symbols:
        i = edge(a, b)
        out += [i] if i != NONE else pieces.byte_ids[data[place[a] : place[b]]].tolist()
    return out


def _encode_texts(data: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, flat, and how many each has."""
    # Every text that is not empty gets a space in front, as the model wants it.
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    n = size[some] + 1
    at = np.cumsum(n) - n
    text = np.full(n.sum(), 0x20, np.uint8)
    inside = np.ones(len(text), bool)
    inside[at] = False
    text[inside] = data[offsets[0] : offsets[-1]]
    space = text == 0x20
    edge = space.copy()
    edge[1:] &= ~space[:-1]
    edge[at] = True
    first = np.flatnonzero(edge)
    length = np.diff(np.r_[first, len(text)])
    up, down = powers(len(text) + 1)
    total = np.r_[U(0), np.cumsum(BYTE[text] * up[:-1], dtype=U)]
    hashes = mix((total[first + length] - total[first]) * down[first] + length.astype(U))
    del total
    _, one, word = np.unique(hashes, return_index=True, return_inverse=True)
    ids, count = _encode_words(_take(text, first[one], length[one]), np.r_[0, np.cumsum(length[one])], pieces)
    begin = np.cumsum(count) - count
    flat = _take(ids, begin[word], count[word])
    each = np.zeros(len(size), np.int64)
    np.add.at(each, some[np.searchsorted(at, first, "right") - 1], count[word])
    return flat, each


Batches = Iterator[pa.RecordBatch]


def _encoder(pieces: Pieces, place: int, names: list[str]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            column = pc.replace_substring(batch.column(place), SPACE, " ")
            data, offsets = text_bytes(column)
            for a, b in spans(offsets, BATCH):
                flat, count = _encode_texts(data, offsets[a : b + 1], pieces)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, lists], names)

    return run


def _decoder(pieces: Pieces, place: int, names: list[str]):
    size = np.array([len(t) for t in pieces.texts] + [0])
    data = np.frombuffer(b"".join(pieces.texts), np.uint8)
    start = np.cumsum(size) - size

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                lists = part.column(place).cast(pa.list_(pa.int64()))
                count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                flat = lists.flatten().fill_null(-1).to_numpy()
                flat = np.where((flat >= 0) & (flat < len(size) - 1), flat, len(size) - 1)
                raw = _take(data, start[flat], size[flat]).tobytes()
                ends = np.r_[0, np.cumsum(size[flat])][np.cumsum(count)]
                texts = []
                for begin, end in zip([0, *ends[:-1]], ends, strict=True):
                    one = raw[begin:end].decode("utf-8", "replace")
                    texts.append(one[1:] if one.startswith(" ") else one)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return run


def _with(docs: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*docs.schema.fields, StructField(name, kind)])


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of ``text`` in an array column ``into``.

    Empty and NULL texts get an empty array; rows, order and other columns stay; a column
    that is named ``into`` already is replaced; an empty table stays empty. The ids are
    those of the model's own library without normalisation rules.
    """
    docs = docs.drop(into)
    run = _encoder(pieces, docs.columns.index(text), [*docs.columns, into])
    return docs.mapInArrow(run, _with(docs, into, ArrayType(IntegerType())))


def decode(docs: DataFrame, pieces: Pieces, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in a column ``into``.

    Pieces are joined and one leading space is taken off; bytes that are no UTF-8 become
    U+FFFD; NULL arrays and NULL or unknown ids give nothing. Otherwise as ``encode``.
    """
    docs = docs.drop(into)
    run = _decoder(pieces, docs.columns.index(ids), [*docs.columns, into])
    return docs.mapInArrow(run, _with(docs, into, StringType()))


def encode_and_decode(
    docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task instead of two."""
    docs = docs.drop(ids, into)
    there = _encoder(pieces, docs.columns.index(text), [*docs.columns, ids])
    back = _decoder(pieces, len(docs.columns), [*docs.columns, ids, into])
    kind = _with(docs, ids, ArrayType(IntegerType())).add(into, StringType())
    return docs.mapInArrow(lambda batches: back(there(batches)), kind)
