"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, all labelled texts with their labels hidden the
unlabelled mixture. Words and word beginnings that positives hold clearly more often are
the features; a linear classifier over them minimises the non-negative risk estimate
``prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)])`` with the logistic loss.
Features are counted and texts scored by tasks; the classifier itself, over a bounded
sample and a bounded number of features, is fitted on the driver in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickloom.llm.common import Scratch
from clickloom.llm.shingles import BASE, PIECE, U, mix, powers, spans, text_bytes

#: Bounds of the fit: texts of either kind in the sample (expected number), and features.
SAMPLE = 12_000
FEATURES = 8_192
#: A feature must occur in so many positives, so many times as often as in the mixture,
#: and so many standard deviations above it.
LEAST, RATIO, SIGMAS = 3, 2.0, 3.5
#: Lengths in bytes of the word beginnings used beside whole words.
BEGINNINGS = (4, 5, 6, 7)

#: Words are runs of ASCII letters and non-ASCII bytes, lower-cased in A-Z.
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[ord("A") : ord("Z") + 1] = _IS_LETTER[ord("a") : ord("z") + 1] = _IS_LETTER[0x80:] = True
_VALUES = mix(np.arange(1, 257, dtype=U) * BASE)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_VALUES[~_IS_LETTER] = 0


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(doc_id):
    """Whether a row's label must not be learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of texts that begin at ``starts`` in ``data``, and the byte each begins at."""
    letter = _IS_LETTER[data]
    begins = np.ones(len(data), bool)
    begins[1:] = ~letter[:-1]
    begins[starts[starts < len(data)]] = True
    ends = np.ones(len(data), bool)
    ends[:-1] = ~letter[1:]
    ends[starts[(starts > 0) & (starts < len(data))] - 1] = True
    first, last = np.flatnonzero(letter & begins), np.flatnonzero(letter & ends) + 1
    up, down = powers(len(data) + 1)
    total = np.r_[U(0), np.cumsum(_VALUES[data] * up[:-1], dtype=U)]
    hashes, at = [mix((total[last] - total[first]) * down[first])], [first]
    for n in BEGINNINGS:
        some = first[last - first >= n]
        hashes.append(mix((total[some + n] - total[some]) * down[some] ^ U(n * 0x632BE59BD9B4E019 % (1 << 64))))
        at.append(some)
    return np.concatenate(hashes), np.concatenate(at)


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, hashes, text of each) of bounded pieces; a long text has several."""
    data, offsets = text_bytes(column)
    for first, last in spans(offsets):
        a, b = int(offsets[first]), int(offsets[last])
        if last - first > 1 or b - a <= PIECE:
            found, at = _features(data[a:b], offsets[first:last] - a)
            yield first, last - first, found, np.searchsorted(offsets[first + 1 : last + 1] - a, at, "right")
            continue
        while a < b:
            end = min(a + PIECE, b)
            while end < b and _IS_LETTER[data[end - 1]] and _IS_LETTER[data[end]]:
                end += 1
            found, at = _features(data[a:end], np.zeros(1, np.int64))
            yield first, 1, found, np.zeros(len(at), np.int64)
            a = end


def _distinct(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs; with ``wanted`` (sorted hashes) features are positions in it."""
    texts, values = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    if wanted is not None:
        seen = np.zeros(1 << 20, bool)
        seen[(wanted >> U(44)).astype(np.int64)] = True
    for first, _, found, text in _pieces(column):
        if wanted is not None:
            maybe = np.flatnonzero(seen[(found >> U(44)).astype(np.int64)])
            found, text = found[maybe], text[maybe]
            place = np.searchsorted(wanted, found)
            hit = wanted[np.minimum(place, len(wanted) - 1)] == found if len(wanted) else np.zeros(len(found), bool)
            found, text = place[hit].astype(U), text[hit]
        order = np.lexsort((found, text))
        found, text = found[order], text[order]
        new = np.r_[True, (found[1:] != found[:-1]) | (text[1:] != text[:-1])][: len(found)]
        texts.append(text[new] + first)
        values.append(found[new])
    text, value = np.concatenate(texts), np.concatenate(values)
    # A text of several pieces may hold a feature in more than one.
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])][: len(value)]
    return text[new], value[new]


def train(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the rows of ``docs`` with a label, held-out ids aside.

    A text with several label rows is positive if one says 1; NULL labels count as none.
    Texts enter the sample by a hash of their id, ``SAMPLE`` positives and ``SAMPLE`` of the
    mixture at most as expected numbers. Without positives the model has no feature and
    scores all texts by the bias alone, close to 0.
    """
    spark = docs.sparkSession
    known = (
        labels.where(F.col(label).isNotNull() & ~held_out(F.col(doc)))
        .groupBy(F.col(doc).alias("_doc"))
        .agg(F.max(F.col(label).cast("int")).alias("_toxic"))
    )
    with Scratch(spark) as scratch:
        known = scratch.table(known, "labels")
        total, positive = known.agg(F.count(F.lit(1)), F.sum("_toxic")).first()
        prior = min(max((positive or 0) / max(total, 1), 1e-3), 0.95)
        if not positive:
            return Model(np.zeros(0, U), np.zeros(0), float(np.log(prior / (1 - prior))))
        draw = F.pmod(F.xxhash64(F.col("_doc").cast("string")), F.lit(1_000_000)) / 1_000_000
        picked = known.select(
            "_doc",
            ((F.col("_toxic") == 1) & (draw < SAMPLE / positive)).alias("p"),
            (draw < SAMPLE / total).alias("u"),
        ).where("p OR u")
        texts = docs.select(F.col(doc).alias("_id"), F.col(text).alias("t"))
        # At most SAMPLE ids of either kind (as expected numbers), so the texts need not move.
        chosen = texts.join(F.broadcast(picked), F.col("_id") == F.col("_doc"))
        sample = scratch.table(chosen.select("_id", "t", "p", "u"), "sample")
        n_p, n_u = sample.agg(F.sum(F.col("p").cast("int")), F.sum(F.col("u").cast("int"))).first()
        if not n_p or not n_u:
            return Model(np.zeros(0, U), np.zeros(0), float(np.log(prior / (1 - prior))))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    row, feature = _distinct(part.column(0))
                    value, of = np.unique(feature, return_inverse=True)
                    p, u = (c.to_numpy(zero_copy_only=False)[row] for c in part.columns[1:])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(value.view(np.int64)),
                            pa.array(np.bincount(of, p, len(value)).astype(np.int64)),
                            pa.array(np.bincount(of, u, len(value)).astype(np.int64)),
                        ],
                        ["f", "p", "u"],
                    )

        counts = sample.select("t", "p", "u").mapInArrow(count, "f bigint, p bigint, u bigint").groupBy("f").agg(
            F.sum("p").alias("p"), F.sum("u").alias("u")
        )
        share_p, share_u = F.col("p") / n_p, (F.col("u") + 1) / (n_u + 1)
        sigmas = (share_p - share_u) / F.sqrt(share_u / n_p)
        best = (
            counts.withColumn("z", sigmas)
            .where((F.col("p") >= LEAST) & (share_p >= RATIO * share_u) & (F.col("z") >= SIGMAS))
            .orderBy(F.col("z").desc(), "f")
            .limit(FEATURES)
            .select("f")
            .collect()
        )
        features = np.sort(np.array([r[0] for r in best], np.int64).view(U))

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, feature = _distinct(batch.column(0), features)
                at = np.searchsorted(row, np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), lists], ["p", "u", "x"])

        rows = sample.select("t", "p", "u").mapInArrow(encode, "p boolean, u boolean, x array<int>").collect()
    weights, bias = fit(
        [np.array(r.x, int) for r in rows if r.p], [np.array(r.x, int) for r in rows if r.u], len(features), prior
    )
    return Model(features, weights, bias)


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], features: int, prior: float,
    steps: int = 500, rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk (Adam, full batches).

    Where the negative part of the risk falls below zero, the step goes up its gradient
    instead, as in the published algorithm.
    """

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        return (
            np.concatenate([np.zeros(0, int), *rows]),
            np.repeat(np.arange(len(rows)), [len(r) for r in rows]),
            len(rows),
        )

    (pf, pr, n_p), (uf, ur, n_u) = flat(positive), flat(unlabelled)
    theta = np.zeros(features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def margins(f: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(r, theta[f], n) + theta[-1]

    def gradient(f: np.ndarray, r: np.ndarray, each: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(f, each[r], features), each.sum()]

    for step in range(1, steps + 1):
        zp, zu = margins(pf, pr, n_p), margins(uf, ur, n_u)
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -50, 50))), 1 / (1 + np.exp(-np.clip(zu, -50, 50)))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_negative = gradient(uf, ur, su / n_u) - prior * gradient(pf, pr, sp / n_p)
        if negative >= 0:
            g = prior * gradient(pf, pr, (sp - 1) / n_p) + g_negative
        else:
            g = -g_negative
        g[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``: 0 to 1, higher is likelier toxic, from the whole text alone.

    Empty and NULL texts get the score of a text without features; a column that is
    named ``into`` already is replaced; all other columns and rows stay.
    """
    docs = docs.drop(into)
    place = docs.columns.index(text)
    names = [*docs.columns, into]
    features, weights, bias = model.features, model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature = _distinct(batch.column(place), features)
            margin = np.bincount(row, weights[feature.astype(np.int64)], batch.num_rows) + bias
            found = pa.array(1 / (1 + np.exp(-np.clip(margin, -50, 50))))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, DoubleType())]))
