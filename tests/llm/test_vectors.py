"""Vector dedup and top-k search against brute force and on awkward rows."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom.llm import near_text, near_vectors, top_k
from plain import components

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def planted(spark):
    """Tight groups, copies, pairs close to the threshold, and unusable rows."""
    rng = np.random.default_rng(5)
    out, label = [], []
    for g in range(12):
        centre = rng.normal(size=24)
        for spread in (0, 0, 0.02, 0.05, 0.07, 0.08, 0.09):
            out.append(centre + spread * 3 * rng.normal(size=24))
            label.append(g % 3)
    out += [rng.normal(size=24) for _ in range(60)]
    label += [0] * 60
    data = [(i, [float(x) for x in v], c, i) for i, (v, c) in enumerate(zip(out, label, strict=True))]
    n = len(data)
    data += [
        (n, None, 0, 1), (n + 1, [0.0] * 24, 0, 1), (n + 2, [NAN] * 24, 0, 1), (n + 3, [INF] + [1.0] * 23, 0, 1),
        (n + 4, [None] + [1.0] * 23, 0, 1), (n + 5, data[0][1], None, 1), (n + 6, [], 0, 1), (n + 7, [1.0, 2.0], 0, 1),
        (n + 8, [1e200] * 24, 1, 1), (n + 9, [2e200] * 24, 1, 1), (None, data[0][1], 0, 1),
    ]
    return spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int, component_id int")


def _able(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_near_vectors(planted):
    data = [r for r in planted.collect() if r.vec_id is not None]
    able = [r for r in data if _able(r.embedding) and any(r.embedding) and r.label is not None]
    unit = {}
    for r in able:
        v = np.array(r.embedding) / np.abs(r.embedding).max()
        unit[r.vec_id] = v / np.sqrt(v @ v)
    links = [
        (a.vec_id, b.vec_id)
        for a in able for b in able
        if a.vec_id < b.vec_id and a.label == b.label and len(a.embedding) == len(b.embedding)
        and unit[a.vec_id] @ unit[b.vec_id] >= 0.93
    ]
    found = components([r.vec_id for r in data], links)
    got = {r.vec_id: r for r in near_vectors.near_vectors(planted).collect()}
    assert set(got) == set(found)
    # Recall of links, as measured; hashing is fixed, so this does not change from run to run.
    count = dict.fromkeys(found, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert sum(r.n_links for r in got.values()) >= 0.99 * 2 * len(links)
    assert all(r.n_links <= count[i] for i, r in got.items())
    assert sum(got[i].component_id != c for i, c in found.items()) <= 1
    assert got[len(data) - 1].n_links == 1  # the huge ones, equal but for their length


def test_blocks_of_one_bucket(planted, monkeypatch):
    """The same result when buckets are cut into many blocks."""
    whole = rows(near_vectors.near_vectors(planted))
    monkeypatch.setattr(near_vectors, "BLOCK", 2)
    assert rows(near_vectors.near_vectors(planted)) == whole


@pytest.mark.parametrize("scale", [1024, 2**40])
def test_top_k(planted, scale):
    data = [r for r in planted.where("vec_id IS NOT NULL").collect() if _able(r.embedding)]
    data = [r for r in data if not r.embedding or max(map(abs, r.embedding)) < 1e100]
    floor = {r.vec_id: [int(np.floor(scale * x)) for x in r.embedding] for r in data}
    want = []
    for q in (i for i in floor if i % 20 == 0):
        score = {i: sum(x * y for x, y in zip(floor[q], v, strict=True)) for i, v in floor.items() if i != q and len(v) == len(floor[q])}
        cut = {i: min(max(s, -(2**63) + 1), 2**63 - 1) for i, s in score.items()}
        best = sorted(cut, key=lambda i: (-cut[i], i))[:7]
        want += [(q, k, i, cut[i]) for k, i in enumerate(best, 1)]
    small = planted.where("embedding IS NULL OR coalesce(abs(get(embedding, 0)), 0D) < 1e100 OR isnan(get(embedding, 0))")
    assert rows(top_k.top_k(small, F.col("vec_id") % 20 == 0, k=7, scale=scale)) == sorted(want, key=lambda r: [str(x) for x in r])


def test_ties_and_copies(spark):
    data = [(i, [1.0, 0.0]) for i in range(40)] + [(40, [2.0, 0.0])]
    got = top_k.top_k(spark.createDataFrame(data, "vec_id bigint, embedding array<float>"), F.col("vec_id") == 0, k=5)
    assert [tuple(r)[2] for r in sorted(got.collect(), key=lambda r: r["rank"])] == [40, 1, 2, 3, 4]


def test_empty(planted):
    none = planted.where("vec_id > 9999")
    assert near_vectors.near_vectors(none).collect() == []
    assert top_k.top_k(none, F.col("vec_id") == 0).collect() == []


def test_similarities_below_the_hashes_raise(spark):
    vectors = spark.createDataFrame([(1, [1.0], "a")], "vec_id bigint, embedding array<double>, label string")
    with pytest.raises(ValueError):
        near_vectors.near_vectors(vectors, cosine=0.9)
    with pytest.raises(ValueError):
        near_text.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), percent=70)


def _pairs(spark, slices=2, groups=3):
    """The plan that scores two queries against four candidates."""
    vectors = [(i, i, 2, [i, 1]) for i in range(4)]
    rows_ = spark.createDataFrame(vectors, "id bigint, h bigint, dim int, v array<bigint>").withColumn("g", (F.col("id") % groups).cast("int"))
    blocks = rows_.select("g", "dim", "id", "h", "v").mapInArrow(top_k._packer(np.int16), top_k.BLOCK)
    asked = rows_.where("id < 2").selectExpr("id", "h", "dim", "v", "CAST(NULL AS BIGINT) base", "3L need")
    return top_k._scored(asked, blocks, (slices, groups), np.int16, 3, 100.0, None, 0)


def test_copied_blocks_are_not_broadcast(spark):
    """Copies of the query blocks are many times what the planner takes them for."""
    plan = _pairs(spark)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(_pairs(spark)) == rows(_pairs(spark, slices=1, groups=1))
    assert {r[0] for r in _pairs(spark).collect()} == {0, 1}


def test_grid_copies_no_side_to_all_cells():
    """The blocks moved in a round grow with the square root of the cells, not with the cells."""
    for queries in (1, 1000, 100_000):
        slices, groups = top_k._grid(400, 100_000, queries)
        assert slices * groups >= 400
        assert queries * groups + 100_000 * slices <= 2.2 * max(100_000, (400 * queries * 100_000) ** 0.5)
