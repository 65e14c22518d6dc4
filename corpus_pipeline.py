"""A training corpus from the documents table: filter, dedup, anonymise, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``documents``; an empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm import mixing, near_text, sentencepiece_ids, surrogates, toxicity
from clickloom.llm.common import Scratch, settle, spare

#: Scores from here on reject a document.
TOXIC = 0.5
WORDS, PERCENT = 5, 80
WEIGHTS, CAP = (5, 2, 1), 3
SURROGATE_KEY = b"corpus pipeline"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is fitted on the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    score = spare(docs, "_toxicity")
    return toxicity.score(docs, model, into=score).where(F.col(score) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows without an id stay.

    Rows that repeat an id are documents of their own where their texts differ, and one
    where they are equal: the first by its other columns stays.
    """
    if docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").isEmpty():
        found = near_text.near_duplicates(docs.select("doc_id", "text"), words=WORDS, percent=PERCENT)
        extra = found.where(~F.col("kept")).select("doc_id").distinct()
        return docs.join(extra, "doc_id", "left_anti").select(*docs.columns)
    print_, number, rank = (spare(docs, name) for name in ("_print", "_number", "_rank"))
    rows = docs.where(F.col("doc_id").isNotNull()).withColumn(print_, F.xxhash64("text"))
    with Scratch(spark) as scratch:
        # Numbers of the distinct (id, text), in their order.
        numbers = rows.select("doc_id", print_).distinct().orderBy("doc_id", print_)
        numbers = scratch.table(numbers.withColumn(number, F.monotonically_increasing_id()), "numbers")
        rows = scratch.table(rows.join(numbers, ["doc_id", print_]).drop(print_), "numbered")
        found = near_text.near_duplicates(rows.select(number, "text"), words=WORDS, percent=PERCENT, doc=number)
        kept = rows.join(found.where("kept").select(F.col("doc_id").alias(number)).distinct(), number)
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        first = F.row_number().over(Window.partitionBy(number).orderBy(*(others or [F.lit(0)])))
        kept = settle(kept.withColumn(rank, first).where(F.col(rank) == 1).select(*docs.columns))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced and ``n_chars`` counted anew."""
    out = surrogates.replace_entities(docs, SURROGATE_KEY, count=spare(docs, "_entities"))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.mixed(docs, WEIGHTS, CAP)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document in the mix."""
    out = sentencepiece_ids.encode(docs.select("doc_id", "source", "text"), sentencepiece_ids.Pieces.load())
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

#: SQL cannot express the classifier, MinHash groups or piece ids.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents table; each stage is written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-2]:
            docs = scratch.table(stage(spark, docs, sf_dir), name)
        # The mix outlives this call, so it is kept where Spark cleans up after it.
        docs = settle(STAGES[-2][1](spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
