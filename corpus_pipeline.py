"""The corpus pipeline: toxicity, near duplicates, repeated passages, contamination, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's rows as Parquet and gives them to the next. All stages but the last return the
columns of ``documents``, and columns beside these are dropped. An empty table gives an
empty one in every stage. Rows with null ids, null languages or null sources are judged by
their texts like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.base import identified, saved, small_batches
from stagewise.llm.op1_toxicity import score_documents, train
from stagewise.llm.op2_substring_dedup import remove_repeats
from stagewise.llm.op5_jaccard_join import jaccard_components
from stagewise.llm.op6_decontamination import found_windows
from stagewise.llm.op9_sentencepiece import encode_texts

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL can't express the first stage.
ORACLE_SQL = None
#: Words of a shingle and per cent of similarity of near duplicates.
SHINGLE, PERCENT = 5, 80


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``did`` and ``th``, by which operators return their decisions."""
    return docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("did"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic. Null and empty texts have
    no terms and stay (unless most labelled documents are toxic); repeated rows stay as often."""
    small_batches(spark)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets alike by 0.8 or more: that
    of the least id (of equal ids, of the least text hash; repeated rows leave one).
    Documents without words stay."""
    found = jaccard_components(docs, SHINGLE, PERCENT)
    chosen = (found.groupBy("component_id", F.when(F.expr("n_shingles = 0"), F.col("did")).alias("empty"),
                            F.when(F.expr("n_shingles = 0 or component_id is null"), F.col("th")).alias("alone"))
              .agg(F.min(F.struct("did", "th")).alias("at")).select("at.did", "at.th"))
    keyed = _keyed(docs)
    kept = keyed.join(chosen, ["did", "th"], "left_semi")
    return kept.dropDuplicates(["did", "th"]).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words that stand elsewhere too; the texts of
    others stay as they are, with their white space. A text that is all repeated becomes
    empty, a null one stays null, repeated rows lose their passages each."""
    gone = remove_repeats(docs).where("size(spans) > 0").groupBy("did", "th").agg(F.first("kept").alias("kept"))
    keyed = _keyed(docs).join(gone, ["did", "th"], "left")
    text = F.coalesce("kept", "text")
    return keyed.select("doc_id", text.alias("text"), "lang", "source",
                        F.when(F.col("kept").isNotNull(), F.char_length("kept")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in twenty inside windows of benchmark items. Null and
    empty texts have no words and stay, repeated rows stay or go together."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = found_windows(identified(docs), items)
    bad = found.where("n_hit > 0 and n_hit * 20 >= n_words").select("did", "th").distinct()
    return _keyed(docs).join(bad, ["did", "th"], "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and whether these decode to the text again; row for
    row, null and empty texts with none."""
    return encode_texts(docs.select(*COLUMNS))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
