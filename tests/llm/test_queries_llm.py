"""The registered queries: against SQL, against plain Python on unusual rows, and on empty tables."""

from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import plain
from comparing import connect, differences
from sensorloom.llm import bpe
from sensorloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def rows_of(frame, *columns):
    return Counter(tuple(row[name] for name in columns) for row in frame.collect())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_no_rows(spark, nothing, name):
    frame = QUERIES[name](spark, nothing)
    assert frame.collect() == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_every_row_has_a_result(spark, edges, name):
    folder, rows = edges
    frame = QUERIES[name](spark, folder)
    if "doc_id" not in frame.columns:  # a search or codes of vectors, tested in test_vectors
        assert frame.count() > 0
        return
    assert Counter(row["doc_id"] for row in frame.collect()) == Counter(row[0] for row in rows)


def test_ngram_join(spark, edges):
    folder, rows = edges
    found = rows_of(QUERIES["op1_ngram_join"](spark, folder), "doc_id", "n_shingles", "component_id")
    wanted = Counter(plain.component_ids([row[:2] for row in rows]))
    blank = {row[0] for row in rows if not plain.shingles(row[1])}
    assert found == wanted and all(key[2] == key[0] for key in found if key[0] in blank and key[1] == 0)


def test_fingerprints(spark, edges):
    folder, rows = edges
    found = QUERIES["op2_simhash"](spark, folder).collect()
    ordered = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0), row[1] or ""))
    wanted = Counter()
    for row, after in zip(ordered, [*ordered[1:], ordered[0]]):
        text, following = row[1] or "", after[1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        own, changed, other = (plain.simhash(part) for part in (text, edited, following))
        wanted[row[0], len(text), plain.sha256(edited), own, changed, plain.likeness(own, changed), plain.likeness(own, other)] += 1
    assert Counter((
        row["doc_id"], row["n_chars"], row["edited_sha256"], row["fingerprint"], row["edited_fingerprint"],
        round(row["near_edited"], 9), round(row["near_next"], 9)) for row in found) == wanted
    prints = {row["doc_id"]: row["fingerprint"] for row in found}
    assert len({prints[200 + i] for i in range(8)} | {prints[1]}) == 1
    assert all(0 <= row[name] <= 1 for row in found for name in ("near_edited", "near_next"))
    long = [row for row in found if row["n_chars"] > 300 and len(set(row["fingerprint"])) > 4]
    assert sum(row["near_edited"] for row in long) / len(long) > 0.5


def test_byte_encoding(spark, edges):
    folder, rows = edges
    ranks = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).whole
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = Counter()
    for row in rows:
        ids = library.encode_ordinary(row[1] or "")
        wanted[row[0], len(ids), plain.sha256(",".join(map(str, ids))), plain.sha256(row[1] or "")] += 1
    frame = QUERIES["op4_byte_encoding"](spark, folder)
    assert rows_of(frame, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted


def test_secret_scan(spark, edges):
    folder, rows = edges
    names = ("assign", "access", "hex", "random")
    found = QUERIES["op5_secret_scan"](spark, folder)
    wanted, whole = Counter(), Counter()
    for row, own in zip(rows, plain.model_spans([row[1] for row in rows])):
        whole[row[0], ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in own)] += 1
        spans = plain.secret_spans(row[1])
        text = ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)
        wanted[row[0], *[sum(s[1] == kind for s in spans) for kind in range(3)], plain.sha256(text)] += 1
    assert rows_of(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == wanted
    assert rows_of(found, "doc_id", "spans") == whole and any("random" in spans for _, spans in whole)


def test_suffix_dedup(spark, edges):
    folder, rows = edges
    wanted = Counter(
        (*row[:4], plain.sha256(row[4])) for row in plain.kept_bytes([row[:2] for row in rows if row[0] not in (411,)]))
    found = rows_of(QUERIES["op6_suffix_dedup"](spark, folder), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    del wanted[()]
    assert Counter({key: n for key, n in found.items() if key[0] != 411}) == wanted


def test_token_counts(spark, edges):
    folder, rows = edges
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter()
    for row in rows:
        n = len(library.encode(row[1] or "", add_special_tokens=False).ids)
        wanted[row[0], len((row[1] or "").encode()), n, n > 512] += 1
    assert rows_of(QUERIES["op7_token_counts"](spark, folder), "doc_id", "n_bytes", "n_tokens", "over_limit") == wanted


def test_quality_rules(spark, edges):
    folder, rows = edges
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = QUERIES["op8_quality_rules"](spark, folder)
    wanted = Counter()
    for row in rows:
        counts = plain.base_statistics(row[1])
        wanted[row[0], *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]] += 1
    assert rows_of(found, "doc_id", *names, "base_failed") == wanted
    kept = {row["doc_id"]: row["kept"] for row in found.collect()}
    assert kept[1] and kept[5] and kept[300] and not kept[400] and not kept[409]


def test_line_dedup(spark, edges):
    folder, rows = edges
    once = [row for row in rows if [r[0] for r in rows].count(row[0]) == 1]
    wanted = {row[0]: (row[1], row[2], plain.sha256(row[3])) for row in plain.line_dedup([row[:2] for row in rows])}
    found = {row["doc_id"]: (row["n_lines"], row["n_removed_lines"], row["kept_sha256"])
             for row in QUERIES["op10_line_dedup"](spark, folder).collect()}
    assert {row[0]: found[row[0]] for row in once} == {row[0]: wanted[row[0]] for row in once}


def test_quality_ranking(spark):
    folder = "/root/testdata/sf0.01"
    found = {row["doc_id"]: row for row in QUERIES["op9_quality_ranking"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [(found[row["doc_id"]]["predicted"], row["quality"]) for row in labels if found[row["doc_id"]]["held_out"]]
    assert len(held) > 30 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all((row["score"] >= 0.3) == bool(row["predicted"]) for row in found.values())


def test_mixing(spark, edges):
    folder, rows = edges
    found = QUERIES["op3_mix_sources"](spark, folder).collect()
    everything = sum(row["size"] for row in found)
    by_target = Counter()
    sizes = {}
    for row in found:
        by_target[row["target"]] += row["taken"]
        sizes[row["target"]] = row["source_size"]
        assert 0 <= row["taken"] <= 2 * row["size"]
    for target, taken in by_target.items():
        assert abs(taken - target) < 1 and target <= 2 * sizes[target] + 1e-9
    assert abs(sum(by_target) - 1.5 * everything) < 1e-6 * everything
    placed = [row["position"] for row in found if row["position"] is not None]
    assert placed == sorted(placed) and 0 <= placed[0] and placed[-1] <= 1
    again = QUERIES["op3_mix_sources"](spark, folder).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
