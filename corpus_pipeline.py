"""From raw documents to token ids: quality rules, line dedup, near duplicates, mixing, encoding.

Every stage takes (spark, documents, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.  ``run`` writes each stage's result to the shared folder and reads it back for the next.

* quality_rules drops the documents that the rules or the robust estimates reject.
* line_dedup takes repeated lines out of the texts, and drops the documents that had lines and have none left.
* ngram_join keeps one document of each group of near duplicates, the one with the least doc_id.
* mixing puts the documents in training order, once for each time that they are taken; the last document
  of a source ends after the words that are still wanted, with its spacing and lines kept; documents without words
  are not taken.
* byte_encoding gives the token ids of every document.

Null doc_ids, languages, sources and texts, repeated rows and empty tables are dealt with as the operators
say; columns other than those of ``documents`` are not carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.llm import byte_encoding as encoding, line_dedup as lines, mixing, ngram_join as near, quality_rules as rules
from sensorloom.llm.common import SPACES, reachable, stored, text_of, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: No SQL: robust estimates and token ids are beyond it; tests compare with plain Python.
ORACLE_SQL = None


def _sized(documents: DataFrame) -> DataFrame:
    return documents.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    # Rows that are equal in all columns get one verdict; only its key is joined back to the texts.
    keyed = documents.select(
        *COLUMNS, F.xxhash64(*COLUMNS).alias("row_a"), F.xxhash64(F.lit(1), *COLUMNS).alias("row_b"))
    kept = rules.judge(keyed, "row_a", "row_b").filter("kept").select("row_a", "row_b").distinct()
    return keyed.join(kept, ["row_a", "row_b"], "left_semi").select(*COLUMNS)


def line_dedup(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    deduped = lines.dedup_lines(documents.select(*COLUMNS))
    return _sized(deduped.filter("n_removed_lines = 0 OR n_removed_lines < n_lines"))


def ngram_join(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return near.first_of_components(documents.select(*COLUMNS)).select(*COLUMNS)


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its count-th word."""
    pieces = F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " ", -1)
    begin = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"), F.lit(0).alias("at"))

    def step(state: Column, piece: Column) -> Column:
        full = state["words"] >= count
        word = F.length(piece) > 0
        return F.struct(
            F.when(full | ~word, state["words"]).otherwise(state["words"] + 1).alias("words"),
            F.when(full | ~word, state["end"]).otherwise(state["at"] + F.length(piece)).alias("end"),
            (state["at"] + F.length(piece) + 1).alias("at"))

    return F.left(text, F.aggregate(pieces, begin, step)["end"])


def mixing_sources(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    sized = documents.select(
        *COLUMNS, F.size(words(text_of())).cast("long").alias("size"), F.xxhash64("text").alias("tie"))
    mixed = mixing.mix(sized, ties=("tie",)).filter("taken > 0")
    passes = F.array(
        F.struct(F.col("position").alias("at"), F.col("first_words").alias("taken")),
        F.struct(F.col("again_position").alias("at"), (F.col("taken") - F.col("first_words")).alias("taken")))
    taken = mixed.withColumn("pass", F.explode(passes)).filter("pass.taken > 0")
    cut = first_words(F.col("text"), F.col("pass.taken"))
    ordered = taken.withColumn("text", F.when(F.col("pass.taken") < F.col("size"), cut).otherwise(F.col("text")))
    return _sized(ordered.orderBy("pass.at", "doc_id"))


def byte_encoding(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    encoded = encoding.encode(documents.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_join", ngram_join),
    ("mixing", mixing_sources), ("byte_encoding", byte_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        documents = stored(stage(spark, documents, sf_dir), name)
    return STAGES[-1][1](spark, documents, sf_dir)
