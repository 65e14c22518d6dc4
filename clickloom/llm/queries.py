"""The operators as queries over the given tables, with the digest columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe_automaton,
    chat_format,
    conversation_trie,
    mixing,
    near_text,
    near_vectors,
    periodic_runs,
    repeats,
    sentence_spans,
    sentencepiece_ids,
    surrogates,
    top_k,
    toxicity,
)
from clickloom.llm.common import WORD, Scratch, settle

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


CONTROL_TURN = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)], rows.schema
    )
    out = chat_format.format_conversations(rows.unionByName(planted))
    turns = chat_format.read_turns(F.col("formatted"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat_format.read_mask(F.col("formatted"), F.col("mask")), "")
    return out.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length(F.col("formatted").cast("string")).cast("long").alias("formatted_chars"),
    )


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies"
    )


def op3_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    with Scratch(spark) as scratch:
        cut = repeats.remove_repeats(_table(spark, sf, "documents"), scratch)
        return settle(
            cut.select(
                "doc_id",
                "n_bytes",
                (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                F.size("removed").cast("long").alias("n_spans"),
                F.sha2("kept", 256).alias("kept_sha256"),
            )
        )


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, into="score").select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_spans.remove_repeated_spans(_table(spark, sf, "documents"), whole=True)


def op6_cross_polytope(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, sf, "embeddings"))


def op7_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_text.near_duplicates(_table(spark, sf, "documents"), words=4)


def op8_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    pieces = sentencepiece_ids.Pieces.load()
    both = sentencepiece_ids.encode_and_decode(docs, pieces)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


#: The key of the registered query; a deployment has its own.
SURROGATE_KEY = b"registered query"


def op10_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def op9_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_bpe_automaton(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    both = bpe_automaton.encode_and_decode(docs, bpe_automaton.load())
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def plant_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where a tenth of the texts, by a hash of the id, go on periodically from some word."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = docs.withColumn("_h", h).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    )
    n = F.nullif(F.size("_words"), F.lit(0))
    words = words.withColumn("_a", (g % n).cast("int")).withColumn(
        "_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int")
    )
    a, p = F.col("_a"), F.col("_p")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_words", a + 1, p), times))
    planted = F.array_join(F.slice(F.concat(F.slice("_words", F.lit(1), a), tail), F.lit(1), n), " ")
    return words.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = plant_runs(_table(spark, sf, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs).select("doc_id", "runs", "collapsed")
    # The greatest length, then the smallest start and period: the least of what sorts so.
    ranked = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("_best", ranked)
    length, period = -F.col("_best.l"), F.col("_best.p")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.s").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-_best.l * 1000) div _best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    found = conversation_trie.sequences(_table(spark, sf, "conversations"))
    conv = F.col("conv_id")
    openings = found.where(conv % 20 == 0).select("conv_id", F.slice("turns", 1, 3).alias("turns"))
    shared = conversation_trie.share_openings(found, openings, conv - conv % 20, F.crc32(conv.cast("string")) % 4)
    return conversation_trie.prefix_trie(shared)


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_mixing": op2_mixing,
    "op3_suffix_array": op3_suffix_array,
    "op4_toxicity": op4_toxicity,
    "op5_sentence_spans": op5_sentence_spans,
    "op6_cross_polytope": op6_cross_polytope,
    "op7_minhash": op7_minhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_top_k": op9_top_k,
    "op10_surrogates": op10_surrogates,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_trie": op13_conversation_trie,
}
