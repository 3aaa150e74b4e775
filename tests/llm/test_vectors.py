"""Vector search, vector codes and periodic runs against plain versions."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import prose
from sensorloom.llm import periodic_runs, queries, vector_codes, vector_search
from sensorloom.llm.common import reachable

VECTORS = "vec_id long, embedding array<float>, label int, score string, cell string, id string, carried string"


def _vectors(spark, rows):
    reachable(spark)
    return spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], VECTORS)


def _clusters(seed, count, size, groups=6, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size))
    return (centres[rng.integers(0, groups, count)] + spread * rng.standard_normal((count, size))).astype(np.float32)


@pytest.fixture(scope="module")
def odd_vectors():
    values = _clusters(1, 300, 8)
    rows = [(i, [float(x) for x in v], None if i % 7 == 0 else i % 3) for i, v in enumerate(values)]
    rows += [(1000 + i, rows[40][1], 1) for i in range(30)]  # copies: ties
    rows += [(40, rows[40][1], 1), (60, rows[61][1], 2)]  # a repeated row, and an id with two vectors
    rows += [(2000, None, 1), (2020, [0.0] * 8, 1), (2040, [1.0, None] + [0.5] * 6, 1), (2060, [math.nan] * 8, 1),
             (2080, [math.inf] + [0.0] * 7, None), (2100, [], 1), (2120, [3.0, -2.0], 2), (None, rows[3][1], 1)]
    return rows


def _nearest(rows, k, every):
    """Item to its k best others; an item's score is the best of its vectors'."""
    taking = [(i, np.pad(np.array(v, float), (0, 8 - len(v)))) for i, v, _ in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q in {i for i, _ in taking if i % every == 0}:
        best = {}
        for mine in (v for i, v in taking if i == q):
            for i, v in taking:
                if i != q:
                    best[i] = max(best.get(i, -math.inf), float((mine * v).sum()))
        out[q] = sorted(best.items(), key=lambda item: (-item[1], item[0]))[:k]
    return out


def _listed(frame):
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(out[row["query_id"]])
    return out


def test_search_equals_brute_force_with_every_leaf_in_reach(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(vector_search, "CERTAIN", 1 - 1e-12)
    found = _listed(vector_search.search(_vectors(spark, odd_vectors), F.col("vec_id") % 20 == 0, k=20))
    expected = _nearest(odd_vectors, 20, 20)
    assert found.keys() == expected.keys()
    for q, items in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in items]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in items], abs=1e-12)


def test_search_in_many_cells_and_blocks_keeps_recall(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "CELL_LEAST", 64)
    monkeypatch.setattr(vector_search, "BLOCK", 100)
    monkeypatch.setattr(vector_search, "LEAF", 8)
    lengths = np.linspace(0.5, 3, 2000)[:, None]
    values = _clusters(2, 2000, 24, groups=40) * lengths
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(values)]
    found = _listed(vector_search.search(_vectors(spark, rows), F.col("vec_id") % 50 == 0, k=10))
    scores = values.astype(np.float32).astype(float) @ values.astype(np.float32).astype(float).T
    np.fill_diagonal(scores, -np.inf)
    hits = sum(len(set(np.argsort(-scores[q])[:10]) & {i for i, _ in items}) for q, items in found.items())
    assert len(found) == 40 and hits >= 0.9 * 400


def test_stopping_test_skips_leaves(spark):
    """On clusters the test ends the search of a block early; what is found is nearly all."""
    values = _clusters(3, 4000, 16, groups=50, spread=0.05).astype(float)
    space = vector_search.Space(16, float(np.sqrt((values ** 2).sum(axis=1).max())))
    block = vector_search.Block(np.arange(4000), values, space, 10)
    own = np.arange(0, 4000, 40)
    points, stretch = space.queries(values[own])
    query, ids, scores = block.search(own, values[own], np.full(len(own), -np.inf))
    last = np.array([scores[query == k].min() for k in range(len(own))])
    away = vector_search.box_distances(points, block.tree.low, block.tree.high)
    assert (away <= space.radius(last, stretch)[:, None]).mean() < 0.5
    exact = values[own] @ values.T
    exact[np.arange(len(own)), own] = -np.inf
    hits = sum(len(set(np.argsort(-exact[k])[:10]) & set(ids[query == k])) for k in range(len(own)))
    assert hits >= 0.9 * 10 * len(own)


def test_chi_square_quantile():
    assert vector_search.chi_square_quantile(0.9, 8) == pytest.approx(13.3616, abs=1e-3)
    assert vector_search.chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-3)


def test_search_of_few_and_no_vectors(spark):
    few = [(20, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.5, 0.5], 1)]
    assert _listed(vector_search.search(_vectors(spark, few), F.col("vec_id") % 20 == 0)) == {20: [(2, 0.5), (1, 0.0)]}
    for rows in ([], [(20, None, 1)]):
        assert vector_search.search(_vectors(spark, rows), F.col("vec_id") % 20 == 0).count() == 0
    alone = vector_search.search(_vectors(spark, few[:1]), F.col("vec_id") % 20 == 0)
    assert alone.count() == 0 and alone.schema.names == ["query_id", "rank", "vec_id", "score"]


def test_search_recall_on_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    found = _listed(queries.QUERIES["op11_vector_search"](spark, folder))
    rows = [(r["vec_id"], r["embedding"], None) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, values = np.array([i for i, _, _ in rows]), np.array([v for _, v, _ in rows], float)
    hits = 0
    for q in found:
        scores = values @ values[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & {i for i, _ in found[q]})
    assert len(found) == (ids % 20 == 0).sum() and hits >= 0.9 * 20 * len(found)


def _plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and None not in v and np.isfinite(v).all()]
    size = -(-max([len(v) for _, v, _ in kept] + [1]) // parts) * parts
    kept = [(i, v + [0] * (size - len(v)), label) for i, v, label in kept]
    deep = size // parts
    cut = [[v[p * deep: (p + 1) * deep] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(p, piece):
        return min((sum((a - b) ** 2 for a, b in zip(piece, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[nearest(p, pieces[p])[1] for p in range(parts)] for pieces in cut]
        books = [[
            [sum(column) // len(column) for column in zip(*members)]
            if (members := [pieces[p] for pieces, own in zip(cut, chosen) if own[p] == e]) else books[p][e]
            for e in range(len(books[p]))] for p in range(parts)]
    last = [[nearest(p, pieces[p]) for p in range(parts)] for pieces in cut]
    errors = [sum(d for d, _ in own) for own in last]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(
        (str(i), "".join(f"{e:02x}" for _, e in own), error, by_label[label], digest)
        for (i, _, label), own, error in zip(kept, last, errors))


@pytest.mark.parametrize("bits, most", [(10, 1 << 16), (13, 3), (4, 1 << 16)])
def test_codes_equal_plain_ones(spark, odd_vectors, bits, most, monkeypatch):
    monkeypatch.setattr(vector_codes.Cells.__init__, "__defaults__", (bits, most))
    coded = vector_codes.compress(_vectors(spark, odd_vectors))
    assert sorted((str(r[0]), *r[1:]) for r in coded.collect()) == _plain_codes(odd_vectors)


def test_codes_of_few_and_no_vectors(spark):
    few = [(5, [0.25] * 8, None), (7, [-0.25] * 8, 1), (7, [-0.25] * 8, 1)]
    assert sorted((str(r[0]), *r[1:]) for r in vector_codes.compress(_vectors(spark, few)).collect()) == _plain_codes(few)
    for rows in ([], [(1, None, 1)], [(1, [math.nan] * 8, 1)]):
        assert vector_codes.compress(_vectors(spark, rows)).count() == 0
    with pytest.raises(Exception, match="absolute value"):
        vector_codes.compress(_vectors(spark, [(1, [1e30] * 8, 1)])).count()


def test_cells_drop_only_dominated_entries():
    rng = np.random.default_rng(4)
    entries, parts = rng.integers(-2000, 2000, (16, 4)), rng.integers(-2500, 2500, (3000, 4))
    cells = vector_codes.Cells(entries, 8)
    index, distance = cells.nearest(parts)
    exact = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    evaluated = sum(bin(mask).count("1") for mask in cells.masks(parts).tolist())
    assert evaluated < 0.5 * parts.shape[0] * 16


def _plain_runs(words, least=12):
    found = set()
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i + period - start
            if i > start and length >= max(least, 2 * period):
                piece = words[start: start + length]
                if all(any(piece[k] != piece[k + q] for k in range(length - q)) for q in range(1, period)):
                    found.add((start, length, period))
            i += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def _plain_row(doc_id, text, altered=True):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    if altered and doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _plain_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in dropped).encode()).hexdigest())


def test_lyndon_lengths_of_both_orders():
    rng = np.random.default_rng(5)
    for _ in range(400):
        letters = rng.integers(1, rng.integers(2, 5), rng.integers(0, 40))
        texts = [letters[i:].tolist() for i in range(len(letters))]
        expected = [next((j for j in range(i + 1, len(texts)) if texts[j] < texts[i]), len(texts)) - i for i in range(len(texts))]
        assert periodic_runs.lyndon_lengths(letters).tolist() == expected


def test_runs_equal_plain_ones_on_many_words():
    rng = np.random.default_rng(6)
    for _ in range(400):
        sequences = []
        for _ in range(rng.integers(1, 4)):
            letters = rng.integers(1, rng.integers(2, 5), rng.integers(1, 80))
            at, period = rng.integers(0, len(letters)), rng.integers(1, 12)
            letters[at:] = letters[at + np.arange(len(letters) - at) % min(period, len(letters) - at)]
            sequences.append(letters)
        owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
        runs, whose = periodic_runs.document_runs(np.concatenate(sequences), owner)
        starts = np.cumsum([0, *map(len, sequences)])
        for k, letters in enumerate(sequences):
            assert [(s - starts[k], n, q) for s, n, q in runs[whose == k].tolist()] == _plain_runs(letters.tolist())


def _row_key(row):
    return [(value is None, str(value)) for value in row]


def test_runs_of_odd_documents(spark, edges):
    folder, rows = edges
    rows = [row for row in rows if row[0] != 411]  # the plain version is slow on the longest text
    odd = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id IS DISTINCT FROM 411")
    reachable(spark)
    for altered in (True, False):
        found = periodic_runs.find_runs(odd, altered=altered, texts=False)
        assert sorted(map(tuple, found.collect()), key=_row_key) == sorted(
            (_plain_row(row[0], row[1], altered) for row in rows), key=_row_key)
    texts = {r["doc_id"]: r["collapsed"] for r in periodic_runs.find_runs(odd).collect()}
    assert texts[409] == "spam and more spam" and texts[410] == "==" and texts[400] == ""


def test_runs_of_long_periodic_texts(spark):
    reachable(spark)
    words = prose(3, 400).split()
    rows = [(1, " ".join(words * 12)), (2, "a " * 30_000), (3, " ".join(words * 3 + ["x"] + words * 2)), (11, prose(4, 900))]
    found = periodic_runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string"), texts=False)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert (by_id[1]["start"], by_id[1]["length"], by_id[1]["period"]) == (0, 4800, 400)
    assert (by_id[2]["n_runs"], by_id[2]["length"], by_id[2]["period"], by_id[2]["exponent_milli"]) == (1, 30_000, 1, 30_000_000)
    assert tuple(by_id[3]) == _plain_row(3, rows[2][1], altered=False)
    assert by_id[11]["n_runs"] == 0 and by_id[11]["start"] is None


def test_runs_of_the_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").filter("length(text) < 8000").collect()
    found = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, folder).collect()}
    for row in rows:
        assert found[row["doc_id"]] == _plain_row(row["doc_id"], row["text"])


def test_runs_of_nothing(spark, nothing):
    assert queries.QUERIES["op13_periodic_runs"](spark, nothing).count() == 0
