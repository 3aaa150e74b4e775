"""The operators beyond what their queries show."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import plain
from plain import prose
from sensorloom.llm import (
    blobs, byte_encoding, line_dedup, mixing, ngram_join, quality_ranking, quality_rules, secret_scan, shared_features,
    simhash, suffix_dedup)
from sensorloom.llm.common import reachable, text_of, words
from sensorloom.llm.components import components


def test_packed_numbers():
    for values in ([], [0], [5, 3, 2 ** 64 - 1], list(range(1000))):
        array = np.array(values, np.uint64)
        assert blobs.unpack(blobs.pack(array)).tolist() == values
        assert blobs.unpack_sorted(blobs.pack_sorted(np.sort(array))).tolist() == sorted(values)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 300), (5, 5)]
    found = {row["node"]: row["label"] for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {
        **{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("commonest, cell", [(64, 2048), (2, 2048), (64, 4)])
def test_join_of_many_near_copies(spark, monkeypatch, commonest, cell):
    """Copies that differ in ever more words, and texts that share a long passage; with and without
    common shingles, in one cell and in many."""
    monkeypatch.setattr(shared_features, "COMMON_LEAST", commonest)
    monkeypatch.setattr(ngram_join, "CELL", cell)
    draw, rows = random.Random(3), []
    base = prose(1, 60).split()
    for i in range(60):
        words = list(base)
        for _ in range(i % 7):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    passage = prose(2, 50)
    rows += [(100 + i, passage + " " + prose(200 + i, 8 + i)) for i in range(20)]
    found = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.drop("text_hash").collect())) == sorted(plain.component_ids(rows))


def test_divide_skip_counts_as_a_full_merge_does():
    draw = random.Random(9)
    for weigh in (0.01, 0.3, 10):
        for _ in range(200):
            lists = [np.array(sorted(draw.sample(range(40), draw.randint(1, 40)))) for _ in range(draw.randint(1, 12))]
            needed = draw.randint(1, 8)
            count = np.bincount(np.concatenate(lists), minlength=40)
            found, common = ngram_join.divide_skip(lists, needed, 40, weigh)
            assert found.tolist() == np.flatnonzero(count >= needed).tolist() and (common == count[found]).all()


def test_first_of_components_keeps_one_row(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A B c d e f", "y"), (1, "A B c d e f", "y"), (1, "a  b c d e f", "z"),
            (7, "other words are here", "x"), (8, None, "x"), (9, "", "x"), (None, "", "x"), (None, "a b c d e f", "x")]
    kept = ngram_join.first_of_components(spark.createDataFrame(rows, "doc_id long, text string, label string"))
    found = [tuple(row) for row in kept.collect()]
    assert sorted(row[0] is not None and row[0] or 0 for row in found) == [0, 1, 7, 8, 9]


def test_first_of_components_tells_components_apart_by_label(spark):
    """A doc_id that leads two components keeps both; a group whose ids are all null keeps one row."""
    copy = prose(41, 40)
    rows = [(5, prose(31, 40)), (5, prose(32, 40)), (6, prose(32, 40) + " more"), (5, prose(33, 40)), (2, prose(33, 40)),
            (None, copy), (None, copy), (None, copy + " end")]
    kept = ngram_join.first_of_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((row["doc_id"] or 0, row["text"]) for row in kept)
    assert found[1:] == sorted([(2, rows[4][1]), (5, rows[0][1]), (5, rows[1][1])])
    assert found[0] in ((0, copy), (0, copy + " end"))


def test_near_counts_with_crowded_keys(spark):
    draw = random.Random(4)
    base = [draw.getrandbits(128) for _ in range(6)]
    prints = set(base)
    for one in base:
        for _ in range(25):
            prints.add(one ^ sum({1 << draw.randrange(128) for _ in range(draw.randint(1, 5))}))
    wanted = {a: sum(1 for b in prints if a != b and (a ^ b).bit_count() <= 3) for a in prints}
    frame = spark.createDataFrame([(bytearray(a.to_bytes(16, "big")),) for a in prints], "fingerprint binary")
    for cell, agreeing in ((2048, None), (4, None), (16, (4, 3))):
        near = simhash.near_counts(frame, cell=cell, agreeing=agreeing)
        found = {int.from_bytes(row["fingerprint"], "big"): row["n_near"] for row in near.collect()}
        assert found == {a: n for a, n in wanted.items() if n}


def test_near_rows_and_links_within_the_radius(spark):
    """Copies count as rows; links are the pairs of distinct fingerprints; in one cell and in many."""
    draw = random.Random(14)
    base = [draw.getrandbits(128) for _ in range(40)]
    rows = [one ^ sum({1 << draw.randrange(128) for _ in range(draw.choice((0, 0, 5, 9, 12)))})
            for one in [*base, *base[:3] * 30] for _ in range(2)]
    frame = spark.createDataFrame(
        [(i, 1, bytearray(a.to_bytes(16, "big"))) for i, a in enumerate(rows)], "doc_id long, n_chars long, fingerprint binary")
    wanted = {i: sum((a ^ b).bit_count() <= simhash.NEAR for b in rows) - 1 for i, a in enumerate(rows)}
    found = simhash.with_near_counts(frame).collect()
    assert {row["doc_id"]: row["n_near"] for row in found} == wanted
    pairs = sorted((a, b, (a ^ b).bit_count()) for a, b in combinations(sorted(set(rows)), 2) if (a ^ b).bit_count() <= simhash.NEAR)
    number = lambda raw: int.from_bytes(raw, "big")
    for cell, agreeing in ((2048, None), (8, None), (2048, (3, 2))):
        links = simhash.near_links(frame, cell=cell, agreeing=agreeing).collect()
        assert sorted((*sorted((number(row["a"]), number(row["b"]))), row["apart"]) for row in links) == pairs


def test_pairs_of_a_cell_by_blocks_and_by_all_pairs(monkeypatch):
    """Rows that share the first block.  Comparing made dear sorts blocks, made cheap it compares all pairs."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 256, (700, 16), dtype=np.uint8)
    noise = np.packbits(draw.random((700, 128)) < 0.07, axis=1)
    prints = np.concatenate([base, base ^ noise])
    prints[:, 0] = 5
    apart = np.bitwise_count(prints[:, None, :] ^ prints[None, :, :]).sum(axis=-1)
    wanted = {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(apart <= 14))) if i < j}
    assert len(wanted) > 500
    for comparing in (1000.0, 1e-9):
        monkeypatch.setattr(simhash, "COMPARING", comparing)
        for m in (2, 3, 4):
            found = Counter()
            for i, j, far in simhash.near_pairs(prints, (0,), np.zeros(len(prints), np.int32), 14, m):
                assert (apart[i, j] == far).all()
                found.update((min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist()))
            assert set(found.values()) == {1} and set(found) == wanted


def test_more_fingerprints_ask_for_more_agreement():
    """Comparisons of a fingerprint grow by less than the fifth root of a hundred thousand times as many."""
    chosen = [simhash.agreement(10 ** power, simhash.NEAR) for power in range(3, 12)]
    assert chosen == sorted(chosen) and chosen[0] == (2, 1) and chosen[-1][0] > 4
    for power, (m, lead) in zip(range(3, 12), chosen):
        keys = 2 ** (128 * lead / (simhash.NEAR + m))
        assert 10 ** power / keys <= simhash.CELL


def test_near_copies_are_near():
    """Single words changed at random while the Jaccard similarity of five-word shingles is 0.75 or more."""
    for words, pairs in ((60, 150), (100, 150), (300, 100), (1000, 60)):
        draw, near = random.Random(words), 0
        for seed in range(pairs):
            base = prose(3000 + seed, words).split()
            own, text = plain.shingles(" ".join(base)), base
            while True:
                changed = list(text)
                changed[draw.randrange(words)] = f"changed{draw.randrange(10 ** 6)}"
                other = plain.shingles(" ".join(changed))
                if len(own & other) < 0.75 * len(own | other):
                    break
                text = changed
            one, two = simhash.fingerprint(" ".join(base)), simhash.fingerprint(" ".join(text))
            near += int(np.bitwise_count(one ^ two).sum()) <= simhash.NEAR
        assert near >= 0.9 * pairs, words


def test_fingerprints_by_plain_votes():
    """Every bit is the sign of the weighted votes, taken term by term."""
    for text in ("one", "a a a b", prose(5, 40), "é\tx9 \n the", prose(6, 400)):
        found = simhash.fingerprint(text)
        assert plain.simhash(text) == bytes(found).hex()


def test_stitching_of_overlapping_chunks():
    draw = random.Random(5)
    pieces = ["a", "bc", " ", "  ", "\n", "'s", "'re", "'", "9", "#", "=", "é", " x"]
    from sensorloom.llm.bpe import SPLIT
    for _ in range(1500):
        chunk, overlap = draw.randint(1, 30), draw.randint(0, 10)
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 120)))
        ends = [byte_encoding.chunk_ends(text[s: s + chunk + overlap]) for s in byte_encoding.chunk_starts(len(text), chunk)]
        assert byte_encoding.stitch(text, ends, chunk, overlap) == SPLIT.findall(text)


def test_encoding_by_small_chunks_and_round_trip(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(1, prose(8, 300), 7), (1, prose(8, 300), 7), (2, "", 8), (None, None, None), (3, "z" * 500, 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long")
    whole = byte_encoding.encode(frame, path)
    small = byte_encoding.encode(frame, path, chunk=64, overlap=8)
    key = lambda row: (str(row["doc_id"]), list(row["ids"]))
    assert sorted(map(key, whole.collect())) == sorted(map(key, small.collect()))
    decoded = byte_encoding.decode(small, path).collect()
    assert sorted(bytes(row["decoded"]) for row in decoded) == sorted((text or "").encode() for _, text, _ in rows)


@pytest.mark.parametrize("commonest", [64, 2])
def test_suffix_dedup_of_overlapping_pieces(spark, monkeypatch, commonest):
    """Texts put together from the same pieces; with and without common anchors and contents."""
    monkeypatch.setattr(shared_features, "COMMON_LEAST", commonest)
    draw = random.Random(8)
    passages = [prose(700 + i, draw.randint(5, 30)) for i in range(8)] + ["=" * 120, "ab" * 45, "é" * 70]
    rows = []
    for i in range(120):
        parts = [draw.choice(passages)[draw.randint(0, 20):] if draw.random() < 0.6 else prose(900 + 7 * i + k, draw.randint(1, 12))
                 for k in range(draw.randint(1, 5))]
        rows.append((draw.randint(-50, 50) if i else None, " ".join(parts)))
    rows += [(60 + i, rows[5][1]) for i in range(4)] + [(None, rows[5][1]), (rows[5][0], rows[5][1])]
    found = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    key = lambda row: (str(row[0]), *row[1:4], bytes(row[4]))
    assert sorted(map(key, map(tuple, found))) == sorted(map(key, plain.kept_bytes(rows)))


def test_suffix_anchors_belong_to_the_string():
    """Equal strings have their anchor at the same place of the string."""
    raw = np.frombuffer((prose(3, 400) + "xyz" + prose(3, 400)).encode(), np.uint8)
    place, _ = suffix_dedup.anchors(raw)
    half = (len(raw) - 3) // 2 + 3
    count = len(place) - half
    assert (place[:count] - np.arange(count) == place[half:half + count] - np.arange(half, half + count)).all()


def test_smaller_places_in_suffix_order():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 7, 60, 500):
        for high in (2, 5, 1000):
            values = rng.integers(0, high, size)
            wanted = [next((j for j in range(i - 1, -1, -1) if values[j] < values[i]), -1) for i in range(size)]
            assert suffix_dedup.smaller_before(values).tolist() == wanted
    assert suffix_dedup.smaller_before(np.arange(5000)[::-1]).tolist() == [-1] * 5000


def test_longest_previous_factors():
    """Against all pairs: places of few letters, so that many strings of 50 bytes are equal or nearly so."""
    rng = np.random.default_rng(3)
    passages = [rng.integers(97, 100, 70, dtype=np.uint8) for _ in range(4)]
    raw = np.concatenate([passages[k] for k in rng.integers(0, 4, 30)] + [np.zeros(64, np.uint8)])
    firsts = rng.integers(0, len(raw) - 64, 400)
    documents = rng.integers(0, 12, 400)
    strings = [raw[at: at + suffix_dedup.LENGTH].tobytes() for at in firsts]
    wanted = [any(b == a and d < c for b, d in zip(strings, documents)) for a, c in zip(strings, documents)]
    found = suffix_dedup.factors_reach(raw, firsts, documents)
    assert found.tolist() == wanted and 0 < found.sum() < 400


def _given_chains(spark):
    return secret_scan.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))


def test_models_find_random_strings_of_any_alphabet(spark):
    """Recall on keys of 16 characters and more, letters alone among them, and of those of 8 and 12."""
    chains, draw = _given_chains(spark), random.Random(7)
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = (small, small + small.upper(), small + digits, small.upper() + digits, small + small.upper() + digits, "abcdef" + digits)
    for alphabet in alphabets:
        found = {}
        for size in (8, 12, 16, 20, 40):
            keys = ["".join(draw.choice(alphabet) for _ in range(size)) for _ in range(200)]
            texts = [f"see {key} there" for key in keys]
            spans = secret_scan.model_spans(texts, [[] for _ in texts], chains)
            assert all(own in ([], [(4, 3, 4 + size)]) for own in spans)
            found[size] = sum(map(bool, spans)) / 200
        assert found[8] >= 0.3 and found[12] >= 0.7 and found[16] >= 0.9 and found[20] >= 0.95 and found[40] == 1


def test_models_leave_ordinary_identifiers(spark):
    """Of 100 identifiers with digits at most 5 are reported, and no plain word or number of the given documents."""
    chains, draw = _given_chains(spark), random.Random(8)
    words = ("customer order export http connection pool size checksum validator invoice summary report account profile image "
             "background version release build parser stream buffer index table column query filter update server client request "
             "response handler manager service controller model view button window event listener thread worker memory").split()
    names = ["customer_order_2024_export_v2", "http2_connection_pool_size", "sha256_checksum_validator_v1", "invoice20240115summaryreport"]
    while len(names) < 100:
        parts = draw.sample(words, draw.randint(2, 4))
        parts.insert(draw.randint(1, len(parts)), draw.choice([str(draw.randint(0, 9999)), f"v{draw.randint(1, 30)}", "20240115"]))
        names.append(draw.choice(["_".join(parts), "-".join(parts), "".join(parts), parts[0] + "".join(map(str.capitalize, parts[1:]))]))
    texts = [f"see {name} there" for name in names]
    assert sum(map(bool, secret_scan.model_spans(texts, [[] for _ in texts], chains))) <= 5
    quiet = ["==========", "-" * 40, "path/to/some/file2", "+1 (974) 555-3436", "9807915762804490", "12345678"]
    assert not any(secret_scan.model_spans(quiet, [[] for _ in quiet], chains))
    keys = "token=9f8e7d6c5b4a39281706f5e4d3"
    assert secret_scan.model_spans([keys], [secret_scan.base_spans(keys)], chains) == [[]]


def test_models_count_all_documents(spark):
    texts = [prose(i, 30) + (" token=Zq9xK2vB7wLm4tRs" if i == 17 else f" End {i}") for i in range(80)]
    chains = secret_scan.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    strings = ["Zq9xK2vB7wLm4tRs", "see Some_name9 there", "café-au-lait"]
    wanted = plain.log_ratios(strings, *plain.chains(texts))
    assert np.allclose(secret_scan.log_ratios(strings, chains), wanted)
    nothing = secret_scan.train(spark.createDataFrame([], "doc_id long, text string"))
    assert np.isfinite(nothing).all()


ODD_NAMES = ("target", "slope", "source_size", "_order", "_slice", "_source", "_start", "_within", "_split", "_kept", "_line_doc",
             "_starts", "_turn", "_blank", "_hash", "row", "rest", "starts", "left", "lines", "first", "turn", "blank", "alone", "label")


def test_other_columns_may_have_any_name(spark):
    rows = [(1, "a\nb\nc\nd", "p"), (2, "x\na\nb\n c\t\ny", "p"), (3, None, None), (3, None, None), (2, "one two", "q"), (4, "", "q")]
    base = spark.createDataFrame(rows, "doc_id long, text string, source string")
    odd = base.select("*", *[F.concat_ws("/", F.lit(name), "doc_id").alias(name) for name in ODD_NAMES])
    whole = lambda row: all(row[name] == f"{name}/{row['doc_id']}" for name in ODD_NAMES)
    reachable(spark)
    deduped = line_dedup.dedup_lines(odd)
    assert deduped.count() == len(rows) and all(map(whole, deduped.collect()))
    first = ngram_join.first_of_components(odd)
    kept = first.collect()
    assert first.columns == odd.columns and all(map(whole, kept))
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == sorted((i, text or "") for i, text, _ in rows)
    mixed = mixing.mix(odd.withColumn("size", F.size(words(text_of())).cast("long")))
    names = [name for name in ODD_NAMES if name not in mixing.RESULTS]
    assert mixed.count() == len(rows)
    assert all(row[name] == f"{name}/{row['doc_id']}" for row in mixed.collect() for name in names)


def test_line_dedup_puts_null_ids_last(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc\nd"), (None, "x\ny\nz"), (None, "q\nx\ny\nz")]
    deduped = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["n_lines"], r["n_removed_lines"]) for r in deduped.collect()) in (
        [(3, 0), (3, 3), (4, 0), (4, 3)], [(3, 3), (3, 3), (4, 0), (4, 0)])
    assert deduped.filter("doc_id = 1").first()["n_removed_lines"] == 0


def test_line_dedup_keeps_other_columns(spark):
    rows = [(1, "a\nb\nc\nd", "p", 1), (2, "x\na\nb\n c\t\ny", "q", 2), (3, None, "r", 3), (2, "a\nb\nc\na\nb\nc", "s", 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lines string, first long")
    found = {row["first"]: row for row in line_dedup.dedup_lines(frame).collect()}
    assert [found[i]["text"] for i in (1, 2, 3, 4)] == ["a\nb\nc\nd", "x\ny", None, ""]
    assert [found[i]["n_removed_lines"] for i in (1, 2, 3, 4)] == [0, 3, 0, 6]
    assert [found[i]["lines"] for i in (1, 2, 3, 4)] == ["p", "q", "r", "s"]


def test_targets_reshare_what_is_over_the_cap(spark):
    sized = spark.createDataFrame([("a", 1, 10), ("b", 2, 1000), ("c", 3, 100), (None, 4, 50), ("d", 5, 0)],
                                  "source string, doc_id long, size long")
    found = {row["source"]: row for row in mixing.targets(sized).collect()}
    weights = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    targets, open_, left = {}, set(weights), 1.5 * 1160
    while True:  # share, stop those above their cap, share the rest again
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > 2 * found[s]["source_size"]}
        if not over:
            break
        for s in over:
            targets[s] = 2.0 * found[s]["source_size"]
            left -= targets[s]
        open_ -= over
    targets.update({s: unit * weights[s] for s in open_})
    assert {s: pytest.approx(row["target"]) for s, row in found.items()} == targets


def test_offsets_are_inverted_demand(spark):
    frame = spark.range(1).select(
        *[mixing.time_of(F.lit(0.3 * 800), F.lit(800.0), F.lit(slope)).alias(f"t{i}") for i, slope in enumerate((-0.5, 0.0, 0.5))])
    for t, slope in zip(frame.first(), (-0.5, 0.0, 0.5)):
        assert t + slope * (t * t - t) == pytest.approx(0.3)


def _estimate(vectors, noise, steps, core):
    """The same estimate in numpy: the least determinant of three starts.  Also which start it came from."""
    def grid(values, share, fine=1):
        return (np.sort(np.floor(values * fine * 256))[max(0, int(np.ceil(share * len(values))) - 1)] + 1) / 256 / fine

    scales = np.array([grid(column, 0.5, 16) for column in quality_rules.NOISE * noise.T])
    middle = np.array([grid(column, 0.5) for column in vectors.T])
    deviation = 1.4826 * np.array([grid(column, 0.5, 16) for column in np.abs(vectors - middle).T])
    ridge, found = np.diag(scales ** 2), []
    for centre, spread in ((middle, ridge), (middle, np.diag(np.maximum(scales, deviation) ** 2)),
                           (vectors.mean(axis=0), np.cov(vectors.T, bias=True) + ridge)):
        def away(centre, spread):
            return np.sqrt(np.einsum("ij,jk,ik->i", vectors - centre, np.linalg.inv(spread), vectors - centre))
        for _ in range(steps):
            inside = vectors[away(centre, spread) < grid(away(centre, spread), core)]
            centre, spread = inside.mean(axis=0), np.cov(inside.T, bias=True) + ridge
        found.append((np.linalg.slogdet(spread)[1], len(found), away(centre, spread) ** 2))
    distance = min(found, key=lambda one: one[:2])[2]
    return distance / max(1.0, grid(np.sqrt(distance), 0.5) ** 2 / quality_rules.MEDIAN), [value for value, _, _ in found]


def test_robust_distances(spark):
    draw = np.random.default_rng(6)
    rows = []
    for group in ("g", "h"):
        for i in range(200):
            words = int(draw.integers(60, 400))
            symbols = 3 * words if i % 20 == 0 else int(draw.integers(0, 5))
            rows.append((i, "en", group, words, int(words * draw.uniform(4, 6)), symbols, words if i % 25 == 0 else 3,
                         10, int(draw.integers(0, 3)), int(draw.integers(0, words // 10))))
    names = "n_words word_chars n_symbols n_upper n_lines n_dup_lines n_repeat_words"
    counted = spark.createDataFrame(rows, "doc_id long, lang string, source string, " + ", ".join(
        f"{name} long" for name in names.split()))
    judged = quality_rules.outliers(quality_rules.vectors(counted).withColumns({
        f"noise_{name}": value for name, value in quality_rules.noise().items()})).toPandas()
    for group in ("g", "h"):
        part = judged[judged["source"] == group]
        noise = part[[f"noise_{name}" for name in quality_rules.NAMES]].to_numpy()
        wanted, determinants = _estimate(
            part[list(quality_rules.NAMES)].to_numpy(), noise, quality_rules.STEPS, quality_rules.CORE)
        assert np.allclose(part["distance"], wanted, rtol=1e-6)
        assert max(determinants) - min(determinants) > 1e-3  # the starts do not all end alike
        assert set(part[part["outlier"]]["doc_id"]) >= {i for i in range(200) if i % 20 == 0}
        assert part["outlier"].sum() <= 20


def test_outliers_agree_with_labels(spark):
    """Junk that passes the base rules is rejected, and good documents stay."""
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    judged = quality_rules.judge(documents.select("doc_id", "text", "lang", "source"), "doc_id").filter("NOT base_failed")
    found = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").groupBy("quality").agg(
        F.count("*").alias("n"), F.sum(F.col("outlier").cast("int")).alias("rejected"))
    counts = {row["quality"]: (row["n"], row["rejected"]) for row in found.collect()}
    assert counts[0][1] == counts[0][0] > 200
    assert counts[1][1] <= 0.005 * counts[1][0]


def test_a_third_of_identical_junk_is_rejected(spark):
    draw = np.random.default_rng(5)
    rows = [(i, int(draw.integers(60, 400)), float(draw.uniform(4.8, 5.2))) for i in range(300)]
    rows = [(i, n, int(n * long), 0, int(n * long * 0.02), 10, 0, 0) if i % 3 else (i, 100, 500, 200, 10, 10, 0, 0)
            for i, n, long in rows]
    names = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words"]
    counted = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{name} long" for name in names))
    vectors = quality_rules.vectors(counted.withColumns({"lang": F.lit("en"), "source": F.lit("g")}))
    judged = quality_rules.outliers(vectors).collect()
    assert {row["doc_id"] for row in judged if row["outlier"]} == set(range(0, 300, 3))


def test_ranking_is_the_least_of_its_loss():
    """The weights against the loss itself, on the same pairs: no small step in any direction lowers it."""
    draw = np.random.default_rng(9)
    vectors = draw.standard_normal((300, 6)) * [1, 2, 3, 1, 1, 1]
    good = vectors @ [1.0, -0.5, 0.2, 0, 0, 0] + draw.standard_normal(300) > 0.4
    ranking = quality_ranking.fit(vectors, good, 0.4, pairs=2000)
    plain_ = (vectors - vectors.mean(axis=0)) / (vectors.std(axis=0) + 1e-6)
    same = np.random.default_rng(0)
    better, worse = plain_[good], plain_[~good]
    pairs = [(better[i], worse[j]) for i, j in zip(same.integers(len(better), size=2000), same.integers(len(worse), size=2000))]

    def loss(weights):
        return sum(np.log1p(np.exp(-(a - b) @ weights)) for a, b in pairs) / 2000 + quality_ranking.PENALTY / 2 * weights @ weights

    least = loss(ranking.weights)
    for k in range(6):
        for step in (-1e-3, 1e-3):
            assert loss(ranking.weights + step * np.eye(6)[k]) > least
    raw = np.sort(ranking.raw(vectors))
    assert ((ranking.scores(vectors) >= 0.3) == (ranking.raw(vectors) >= ranking.threshold)).all()
    assert raw[0] < ranking.threshold < raw[-1]


def test_words_are_learned():
    """Texts that differ in nothing but their words."""
    draw = random.Random(4)
    text = lambda good: " ".join(draw.choice(("amber basil cedar" if good else "vapor xenon zinca").split() + ["other", "words"])
                                 for _ in range(60))
    labels = np.array([i % 2 == 0 for i in range(200)])
    vectors = np.array([quality_ranking.features(text(good)) for good in labels])
    ranking = quality_ranking.fit(vectors, labels, 0.5)
    fresh = [quality_ranking.features(text(good)) for good in labels]
    assert ((ranking.scores(np.array(fresh)) >= 0.3) == labels).all()
    shares = quality_ranking.buckets(Counter({"Amber": 1, "amber": 2, "zinca": 1}))
    assert shares[zlib.crc32(b"amber") % quality_ranking.BUCKETS] == pytest.approx(0.75 ** 0.5) and (shares ** 2).sum() == pytest.approx(1)


def test_ranking_learns_from_every_labelled_row(spark, monkeypatch):
    """Each pair holds a row of either label, and all rows are in pairs, with a rare label too."""
    monkeypatch.setattr(quality_ranking, "GROUP_ROWS", 40)
    seen = []
    original = quality_ranking._pairs
    monkeypatch.setattr(quality_ranking, "_pairs", lambda rows, sizes: seen.append((rows, sizes, original(rows, sizes))) or seen[-1][2])
    texts = [(i, f"{'amber basil' if i % 9 == 0 else 'vapor xenon'} w{i} " * (3 + i % 7)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i, _ in texts], "doc_id long, quality int")
    ranking = quality_ranking.train(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    used = [(i, text) for i, text in texts if zlib.crc32(str(i).encode()) % 5]
    rows, sizes, pairs = seen[0]
    assert sizes == {1: sum(i % 9 == 0 for i, _ in used), 0: sum(i % 9 != 0 for i, _ in used)}
    vectors = {i: quality_ranking.features(text) for i, text in used}
    differences = np.array([np.frombuffer(bytes(row["x"])) for row in pairs.collect()])
    good = {tuple(vectors[i]) for i, _ in used if i % 9 == 0}
    bad = {tuple(vectors[i]) for i, _ in used if i % 9}
    assert len(differences) >= sizes[0]
    made = {tuple(np.round(np.array(g) - np.array(b), 9) + 0.0): (g, b) for g in good for b in bad}
    met = [made[tuple(np.round(one, 9) + 0.0)] for one in differences]
    assert {g for g, _ in met} == good and {b for _, b in met} == bad
    raw = np.sort(ranking.raw(np.array([vectors[i] for i, _ in used])))
    cut = sizes[0]
    assert ranking.threshold == pytest.approx((raw[cut - 1] + raw[cut]) / 2, abs=1e-9)


def test_ranking_without_two_labels():
    ranking = quality_ranking.fit(np.zeros((3, quality_ranking.WIDTH)), np.array([True] * 3), 0.0)
    assert ranking.scores(np.zeros((2, quality_ranking.WIDTH))).tolist() == [0.5, 0.5]


def test_split_pattern_is_the_published_one():
    import public_tokenizers
    from sensorloom.llm.bpe import SPLIT
    text = prose(11, 500) + " it's  we'll\t\n x9 ##"
    assert SPLIT.findall(text) == regex.findall(public_tokenizers.PATTERN, text)
