"""The queries of this package over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.llm import (
    byte_encoding as byte_encoding_, line_dedup, mixing, ngram_join, periodic_runs, quality_ranking, quality_rules,
    secret_scan, simhash, suffix_dedup, token_counts, vector_codes, vector_search)
from sensorloom.llm.common import reachable, sha256, text_of

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 512

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING_SQL = rf"""
WITH sized AS (SELECT doc_id, source, len({_WORDS})::bigint AS size FROM documents),
by_source AS (
  SELECT source, sum(size)::bigint AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source),
weighted AS (
  SELECT *, [3.0, 1.0, 2.0][turn % 3 + 1]::double AS weight, [-0.5, 0.0, 0.5][turn % 3 + 1]::double AS slope,
         2.0::double * source_size AS cap FROM by_source),
levels AS (
  SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT min_by(level, cap / weight) AS level FROM levels WHERE level <= cap / weight),
goals AS (
  SELECT source, source_size, slope, least(cap, coalesce(chosen.level, 'infinity'::double) * weight) AS target
  FROM levels LEFT JOIN chosen ON true),
placed AS (
  SELECT doc_id, size, source_size, target, slope,
         (sum(size) OVER (PARTITION BY goals.source ORDER BY md5(coalesce(doc_id::varchar, '')), doc_id NULLS FIRST, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::bigint AS start
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
taken AS (
  SELECT *, greatest(0, least(size, floor(target)::bigint - start)) AS first_words,
         greatest(0, least(size, floor(target)::bigint - start - source_size)) AS again_words FROM placed)
SELECT doc_id, size, source_size, target, (first_words + again_words)::bigint AS taken,
       CASE WHEN first_words > 0 THEN round(2 * (start / target) / (
         1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * (start / target))), 9) END AS position
FROM taken
"""


@query("op3_mix_sources", MIXING_SQL)
def mix_sources(spark, sf_dir):
    """Words taken of every document, in training order."""
    sized = mixing.word_sizes(documents(spark, sf_dir, "doc_id", "source", "text"))
    ordered = mixing.in_training_order(mixing.mix(sized))
    return ordered.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


@query("op8_quality_rules")
def quality(spark, sf_dir):
    """Statistics, base rules and the robust verdict for every document."""
    judged = quality_rules.judge(documents(spark, sf_dir, "doc_id", "lang", "source", "text"), "doc_id")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 4).alias("distance"))


LINES_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
trimmed AS (
  SELECT doc_id, lines, list_transform(lines, lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))) AS plain
  FROM split),
windows AS (
  SELECT doc_id, pos, plain[pos + 1] AS l1, plain[pos + 2] AS l2, plain[pos + 3] AS l3
  FROM (SELECT doc_id, plain, unnest(range(len(plain) - 2)) AS pos FROM trimmed WHERE len(plain) >= 3)),
places AS (
  SELECT *, first_value(doc_id) OVER one AS first_doc, first_value(pos) OVER one AS first_at
  FROM windows WHERE l1 || l2 || l3 <> ''
  WINDOW one AS (PARTITION BY l1, l2, l3 ORDER BY doc_id NULLS LAST, pos)),
covered AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS line FROM places
  WHERE doc_id IS DISTINCT FROM first_doc OR pos >= first_at + 3),
numbered AS (SELECT doc_id, generate_subscripts(lines, 1) - 1 AS line, unnest(lines) AS body FROM split)
SELECT numbered.doc_id, count(*) AS n_lines, count(covered.line) AS n_removed_lines,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY numbered.line) FILTER (covered.line IS NULL), '')) AS kept_sha256
FROM numbered LEFT JOIN covered ON numbered.doc_id IS NOT DISTINCT FROM covered.doc_id AND numbered.line = covered.line
GROUP BY numbered.doc_id
"""


@query("op10_line_dedup", LINES_SQL)
def line_windows(spark, sf_dir):
    """Line counts and the digest of what is left of every document."""
    deduped = line_dedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text"))
    return deduped.select("doc_id", "n_lines", "n_removed_lines", sha256(text_of()).alias("kept_sha256"))


@query("op4_byte_encoding")
def byte_encoding(spark, sf_dir):
    """Ids of every document, and the digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_encoding_.encode(documents(spark, sf_dir, "doc_id", "text"), path)
    return byte_encoding_.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_token_counts")
def token_count(spark, sf_dir):
    """Bytes and tokens of every document, and whether they are over the limit."""
    texts = documents(spark, sf_dir, "doc_id", "text")
    sized = texts.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), "text")
    counted = token_counts.count_tokens(sized, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op5_secret_scan")
def secrets(spark, sf_dir):
    """Spans of the base patterns and of the models in every document."""
    texts = documents(spark, sf_dir, "doc_id", "text")
    spans = F.col("spans")
    return secret_scan.scan(texts, secret_scan.train(texts)).select(
        "doc_id", *[secret_scan.counted(spans, kind).alias(f"n_{secret_scan.KINDS[kind]}") for kind in range(3)],
        sha256(secret_scan.written(spans, (0, 1, 2))).alias("base_sha256"), secret_scan.written(spans).alias("spans"))


@query("op9_quality_ranking")
def ranking(spark, sf_dir):
    """Quality score of every document, learned outside the held-out fold."""
    texts = documents(spark, sf_dir, "doc_id", "text")
    learned = quality_ranking.train(texts, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(quality_ranking.remainder() == 0, F.lit(False))
    return quality_ranking.score(texts, learned).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality_ranking.CUT).cast("int").alias("predicted"))


@query("op1_ngram_join")
def ngrams(spark, sf_dir):
    """Shingle count and component of every document."""
    return ngram_join.join_components(documents(spark, sf_dir, "doc_id", "text")).drop("text_hash")


@query("op2_simhash")
def prints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how many others are near."""
    found = simhash.with_near_counts(simhash.fingerprints(documents(spark, sf_dir, "doc_id", "text")))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
        "n_near")


@query("op6_suffix_dedup")
def suffixes(spark, sf_dir):
    """Bytes that every document loses to earlier ones, and the digest of what it keeps."""
    return suffix_dedup.dedup(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_vector_search")
def nearest(spark, sf_dir):
    """The 20 nearest found of every twentieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return vector_search.search(vectors, F.col("vec_id") % 20 == 0, k=20)


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The codebooks of all rounds one after another, each from the one before."""
    steps = [rf"""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
cut AS (
  SELECT row, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS piece
  FROM kept, unnest(range({parts})) AS u(part)),
book0 AS (SELECT part, row - 1 AS entry, piece AS mean FROM cut WHERE row <= {entries})"""]
    for turn in range(rounds + 1):
        steps.append(rf"""
near{turn} AS MATERIALIZED (
  SELECT row, part, any_value(piece) AS piece, min((distance, entry)) AS best
  FROM (SELECT row, cut.part, piece, entry,
               list_sum(list_transform(list_zip(piece, mean), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint AS distance
        FROM cut JOIN book{turn} b ON cut.part = b.part)
  GROUP BY row, part)""")
        if turn < rounds:
            steps.append(rf"""
sums{turn} AS (
  SELECT part, entry, list(mean ORDER BY place) AS mean
  FROM (SELECT part, best[2] AS entry, place, floor_divide(sum(x)::bigint, count(*)::bigint) AS mean
        FROM (SELECT part, best, unnest(piece) AS x, unnest(range(1, len(piece) + 1)) AS place FROM near{turn})
        GROUP BY part, best[2], place)
  GROUP BY part, entry),
book{turn + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(s.mean, b.mean) AS mean
  FROM book{turn} b LEFT JOIN sums{turn} s ON b.part = s.part AND b.entry = s.entry)""")
    chosen = ",".join(steps).replace(
        "floor_divide(sum(x)::bigint, count(*)::bigint)",
        "((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) / count(*))::bigint".replace(" / ", " // "))
    return rf"""
WITH {chosen},
coded AS (
  SELECT row, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::bigint AS error
  FROM near{rounds} GROUP BY row),
digest AS (
  SELECT sha256(string_agg(array_to_string(mean, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}),
by_label AS (SELECT label, sum(error)::bigint AS label_error FROM kept JOIN coded USING (row) GROUP BY label)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN coded USING (row) JOIN by_label ON kept.label IS NOT DISTINCT FROM by_label.label, digest
"""


@query("op12_vector_codes", vector_codes_sql())
def codes(spark, sf_dir):
    """Code and errors of every vector."""
    return vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_periodic_runs")
def runs(spark, sf_dir):
    """Runs of repeated words of every document, and the digest of its words without repetitions."""
    return periodic_runs.find_runs(documents(spark, sf_dir, "doc_id", "text"), altered=True, texts=False)
