"""Substring dedup by sliding sentence spans.

Every run of RUN consecutive sentences is hashed and all runs meet in one join; sentences
that a run covers which is not the first of its kind go. Runs of very few words say
nothing: they do not count or, if ``whole``, go on until they hold LEAST_WORDS words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Scratch, settle
from clickloom.llm.shingles import U, mix, spans, text_bytes, word_table

#: Sentences to a run, words to a run at least, words to a sentence at most.
RUN, LEAST_WORDS, MOST_WORDS = 2, 10, 25
#: Cuts by content begin at the word with the least hash of every so many (a power of two).
WINDOW = 8
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?")]] = True
FACTOR = U(0xD6E8FEB86659FD93)
_FACTOR_INVERSE = U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _least_of_windows(hashes: np.ndarray, part: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the least hash (the last of equal ones) of every WINDOW words within a chosen part."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, width = np.arange(len(hashes)), 1
    while width < WINDOW:
        left, right = at[:-width], at[width:]
        at = np.where(hashes[right] <= hashes[left], right, left)
        width *= 2
    return at[chosen[:n] & (part[:n] == part[WINDOW - 1 :])]


def sentences(column: pa.Array, whole: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of ranges of texts: (first, last, text number, first byte, words, hash) per sentence.

    A sentence ends after a word that ends in a full stop, exclamation or question mark,
    at a line's end, or at MOST_WORDS words. If ``whole``, one of more than MOST_WORDS words
    is cut by content instead, before the word with the least hash of every WINDOW words,
    so what two of them share is cut alike wherever it lies, but for less than WINDOW words
    at each end. The first byte counts from the text's start.
    """
    data, offsets = text_bytes(column)
    for first, last in spans(offsets):
        hashes, begin, end, text = word_table(data, offsets[first : last + 1], lower=False)
        n = len(hashes)
        if not n:
            continue
        opens = np.ones(n, bool)
        lines = np.r_[0, np.cumsum(data[begin[0] : end[-1]] == 0x0A)]
        line = lines[begin - begin[0]]
        opens[1:] = _STOP[data[end[:-1] - 1]] | (line[1:] != line[:-1]) | (text[1:] != text[:-1])
        place = np.arange(n)
        if whole:
            part = np.cumsum(opens) - 1
            opens[_least_of_windows(hashes, part, np.bincount(part)[part] > MOST_WORDS)] = True
        else:
            opens |= (place - np.maximum.accumulate(np.where(opens, place, 0))) % MOST_WORDS == 0
        start = np.flatnonzero(opens)
        count = np.diff(np.r_[start, n])
        up = np.cumprod(np.r_[U(1), np.full(n, FACTOR, U)], dtype=U)
        down = np.cumprod(np.r_[U(1), np.full(n, _FACTOR_INVERSE, U)], dtype=U)
        total = np.r_[U(0), np.cumsum(hashes * up[:-1], dtype=U)]
        value = mix((total[start + count] - total[start]) * down[start] + count.astype(U))
        yield first, last, text[start], begin[start] - offsets[first + text[start]], count, value


def _runs(
    text: np.ndarray, count: np.ndarray, value: np.ndarray, whole: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, sentences and hash of the runs of one text with enough words.

    If ``whole``, the shortest run of at least RUN sentences and LEAST_WORDS words goes out
    from every sentence and another leads up to every sentence, so together they cover any
    longer passage to both its ends. If not, runs have RUN sentences.
    """
    n = len(text)
    place, words = np.arange(n), np.r_[0, np.cumsum(count)]
    stop = np.maximum(place + RUN, np.searchsorted(words, words[:-1] + LEAST_WORDS))
    start = np.minimum(place + 1 - RUN, np.searchsorted(words, words[1:] - LEAST_WORDS, "right") - 1)
    out = place[stop <= np.searchsorted(text, text, "right")]
    up_to = place[start >= np.searchsorted(text, text)]
    # Most runs that lead up to a sentence are those that go out from their first.
    up_to = up_to[stop[start[up_to]] != up_to + 1]
    if not whole:
        out, up_to = out[stop[out] == out + RUN], up_to[:0]
    first, end = np.r_[out, start[up_to]], np.r_[stop[out], up_to + 1]
    up = np.cumprod(np.r_[U(1), np.full(n, FACTOR, U)], dtype=U)
    down = np.cumprod(np.r_[U(1), np.full(n, _FACTOR_INVERSE, U)], dtype=U)
    total = np.r_[U(0), np.cumsum(value * up[:-1], dtype=U)]
    return first, end - first, mix((total[end] - total[first]) * down[first] + (end - first).astype(U))


def _spans(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, prints = (batch.column(c).to_numpy() for c in (0, 1))
        for first, last, text, _, count, value in sentences(batch.column(2), whole):
            at, size, hashes = _runs(text, count, value, whole)
            sentence = at - np.searchsorted(text, text[at])
            doc = first + text[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)), pa.array(ids[doc]), pa.array(prints[doc]),
                    pa.array(sentence.astype(np.int32)), pa.array(size.astype(np.int8)),
                ],
                ["h", "doc_id", "print", "place", "size"],
            )


def _cut(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences of the given runs (place, size)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        total = np.zeros(batch.num_rows, np.int64)
        removed = np.zeros(batch.num_rows, np.int64)
        kept = [bytes(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        gone = batch.column(2)
        for first, last, text, begin, _, _ in sentences(batch.column(1), whole):
            edges = np.searchsorted(text, np.arange(last - first + 1))
            total[first:last] = np.diff(edges)
            for i in range(first, last):
                if not gone[i].is_valid:
                    continue
                a, b = edges[i - first], edges[i - first + 1]
                places, sizes = (c.to_numpy() for c in gone[i].values.flatten())
                edge = np.zeros(b - a + 1, np.int64)
                np.add.at(edge, places, 1)
                np.add.at(edge, places + sizes, -1)
                cut = np.cumsum(edge[:-1]) > 0
                size = offsets[i + 1] - offsets[i]
                stop = np.r_[begin[a + 1 : b], size]
                mark = np.zeros(size + 1, np.int32)
                mark[begin[a:b][cut]] += 1
                mark[stop[cut]] -= 1
                text_ = data[offsets[i] : offsets[i + 1]]
                kept[i] = text_[np.cumsum(mark[:-1]) == 0].tobytes()
                removed[i] = cut.sum()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total), pa.array(removed), pa.array([k.decode() for k in kept], pa.string())],
            ["doc_id", "n_sentences", "n_removed", "text"],
        )


def remove_repeated_spans(docs: DataFrame, doc: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Per row: doc_id, n_sentences, n_removed, text (what is left).

    ``whole`` removes repeated passages of short sentences too, all of whose pairs have fewer
    than LEAST_WORDS words: runs go on over further sentences until they hold enough words.
    It cuts sentences of more than MOST_WORDS words by content, so repeated passages without
    full stops go wherever they begin. A repeated passage may keep at each end a part of a
    sentence: less than WINDOW words of one cut in both places, at most MOST_WORDS of others.

    The first of equal runs is the one in the smallest doc_id, there the earliest; all
    others go, within one text too. White space between words does not tell runs apart.
    NULL texts are empty; empty texts and those of fewer than RUN sentences stay as they
    are; rows that repeat id and text are one document and all get its result; rows
    without an id are left out; further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(doc).isNotNull()).select(
        F.col(doc).cast("long").alias("doc_id"), F.xxhash64(text).alias("print"), F.col(text).cast("string").alias("text")
    )
    with Scratch(spark) as scratch:
        runs = rows.mapInArrow(partial(_spans, whole=whole), "h bigint, doc_id bigint, print bigint, place int, size tinyint")
        runs = scratch.table(runs, "runs")
        first = runs.groupBy("h").agg(
            F.min(F.struct("doc_id", "print", "place")).alias("first"), F.max(F.struct("doc_id", "print", "place")).alias("last")
        )
        first = scratch.table(first.where("first != last").select("h", "first"), "repeated")
        later = runs.join(first, "h").where(F.struct("doc_id", "print", "place") != F.col("first"))
        # A document's places are bounded by its text; equal rows give equal places.
        gone = later.groupBy("doc_id", "print").agg(F.collect_set(F.struct("place", "size")).alias("runs"))
        gone = settle(gone.withColumnsRenamed({"doc_id": "d", "print": "p"}))
    joined = rows.join(gone, (F.col("doc_id") == F.col("d")) & (F.col("print") == F.col("p")), "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(
        partial(_cut, whole=whole), "doc_id bigint, n_sentences bigint, n_removed bigint, text string"
    )

