"""The pipeline, stage by stage, against plain Python."""

from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline as pipeline
import plain
from sensorloom.llm import bpe
from sensorloom.llm.common import stored


def test_stages(spark, edges):
    folder, rows = edges
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "ngram_join", "mixing", "byte_encoding"]
    documents = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id IS NULL OR doc_id <> 411")

    judged = stored(stages["quality_rules"](spark, documents, folder), "t")
    assert judged.columns == pipeline.COLUMNS
    ids = {row["doc_id"] for row in judged.collect()}
    assert {1, 2, 3, 100, 300} <= ids and not ids & {400, 401, 403, 409, 413}

    deduped = stored(stages["line_dedup"](spark, judged, folder), "t")
    before = [(row["doc_id"], row["text"]) for row in judged.collect()]
    wanted = {(i, text) for i, lines, gone, text in plain.line_dedup(before) if gone < lines}
    once = {i for i, n in Counter(row[0] for row in before).items() if n == 1}
    found = {(row["doc_id"], row["text"]) for row in deduped.collect()}
    assert {row for row in found if row[0] in once} == {row for row in wanted if row[0] in once}
    assert all(row["n_chars"] == len(row["text"]) for row in deduped.collect())

    unique = stored(stages["ngram_join"](spark, deduped, folder), "t")
    texts = [(row["doc_id"], row["text"]) for row in deduped.collect()]
    groups = {(i, component) for i, _, component in plain.component_ids(texts)}
    assert {row["doc_id"] for row in unique.collect() if row["doc_id"] is not None} == {
        i for i, component in groups if i is not None and i == component}

    mixed = stored(stages["mixing"](spark, unique, folder), "t")
    assert mixed.columns == pipeline.COLUMNS
    size = lambda text: len(plain.WORD.findall(text))
    whole = sum(size(row["text"]) for row in unique.collect())
    taken = Counter()
    for row in mixed.collect():
        taken[row["source"]] += size(row["text"])
    assert abs(sum(taken.values()) - 1.5 * whole) <= len(taken) + 1
    assert max(Counter(row["doc_id"] for row in mixed.collect()).values()) <= 2

    ranks = bpe.load(public_tokenizers.path(pipeline.VOCABULARY)).whole
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = stages["byte_encoding"](spark, mixed, folder).collect()
    assert Counter(tuple(row["ids"]) for row in encoded) == Counter(
        tuple(library.encode_ordinary(row["text"])) for row in mixed.collect())


def test_empty_table(spark, nothing):
    assert pipeline.run(spark, nothing).collect() == []
