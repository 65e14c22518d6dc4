"""The registered queries against SQL, and the pipeline against its parts in plain Python."""

import duckdb
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from clickloom.llm import sentencepiece_ids, surrogates
from clickloom.llm.oracle import ORACLE
from clickloom.llm.queries import QUERIES
from plain import near_groups


def test_registered():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_result_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = con.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


def test_pipeline(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before, docs)
        if name != "sentencepiece":
            assert docs.columns == columns
    texts = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = before.join(labels.where("toxic = 0"), "doc_id")
    gone = clean.join(after, "doc_id", "left_anti").count()
    assert gone <= 0.02 * clean.count() and after.count() < before.count()

    before, after = kept["near_duplicates"]
    groups = near_groups(texts(before), 5)
    assert {i for i, _ in texts(after)} == {i for i, (_, c) in groups.items() if i == c}

    before, after = kept["personal_data"]
    old, new = dict(texts(before)), dict(texts(after))
    assert set(old) == set(new)
    for i in old:
        was, now = surrogates.find(old[i]), surrogates.find(new[i])
        assert len(was) == len(now) and all(a[3] != b[3] for a, b in zip(was, now, strict=True))
        assert bool(was) or old[i] == new[i]
    assert after.where(F.char_length("text") != F.col("n_chars")).isEmpty()

    before, after = kept["mixing"]
    assert {i for i, _ in texts(after)} <= {i for i, _ in texts(before)}
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_ids.MODEL)
    before, after = kept["sentencepiece"]
    want = sorted((i, len(library.encode(t)), library.encode(t)) for i, t in texts(before))
    assert sorted((r.doc_id, r.n_ids, r.ids) for r in after.collect()) == want

    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, after.collect()))


def test_near_duplicates_of_repeated_ids(spark, sf_dir):
    """Rows of one id go by their own texts; equal rows are one document."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    data = [(3, text("a")), (5, text("a")), (5, text("b")), (6, text("c") + " more"), (8, text("c")), (8, text("d")),
            (8, text("d")), (9, text("d") + " more"), (9, text("e")), (None, text("a")), (None, text("a"))]
    docs = spark.createDataFrame([(i, t, "web", 1) for i, t in data], "doc_id bigint, text string, source string, n_chars int")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text) for r in out.collect())
    want = [(0, "a"), (0, "a"), (3, "a"), (5, "b"), (6, "c"), (8, "d"), (9, "e")]
    assert [(i, t[0]) for i, t in got] == want


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
