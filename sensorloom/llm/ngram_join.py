"""N-gram Jaccard self-join: T-occurrence search with short and long inverted lists.

A document's set holds the hashes of its distinct shingles of words.  Documents with equal sets are one
class, and classes are joined.  An inverted list holds the classes of a shingle.  A class x with n
shingles can only link to classes that share T = ceil(threshold * n) of them.  The lists of x are
ordered by length, which is the same order for all classes: its T - 1 longest lists are the long ones,
the others the short ones, and whatever links to x is in a short list of x and, as the order is common,
of its own.  The short lists are merged, by Spark's sort-merge shuffles; each candidate is then probed
for the shingles of the long lists by binary search in its sorted set, and stays if T are met.

Before that, a class is given up when fewer than T of its lists hold another class.  This needs every
list once: tasks send the shingles, packed into few rows, to ranges of hash values, and get back those
that occur in two classes or more.  Shingles that a thousandth of all documents share are known beforehand and
not sent: their number is bounded, and they count as the longest lists.

Links between a group's members are not all emitted.  Every list first links its members to one of
them; whatever is in one component by then needs no further probe, and only pairs of classes from
different components of a list are probed in the end.

Defined results: a null, empty or blank text has no shingles and links to nothing; fewer words than a
shingle has make one shingle; rows that repeat a doc_id are documents of their own; a component whose
ids are all null has a null id; no documents give no rows.  Sets are compared by 56-bit hashes and
classes told apart by 64-bit ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm import blobs, shared_features
from sensorloom.llm.arrow_rows import PARCEL_PORTION, portions
from sensorloom.llm.common import routes_for, stored
from sensorloom.llm.components import components
from sensorloom.llm.shared_features import BITS, PARCEL

WORDS, PERCENT = 5, 75
#: Classes that meet in one task at most, from each of two sides; weight of merging against probing.
CELL, WEIGH = 2048, 0.3
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text.  bytes.split and bytes.lower know the
    same blanks and letters as the contract: ASCII ones."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    mixed = hashes[: len(found) - width + 1] + np.uint64(width)
    for step in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX + hashes[step: len(found) - width + 1 + step]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX
    return np.unique(mixed >> np.uint64(64 - BITS))


def class_key(members: np.ndarray) -> int:
    """64-bit identity of a set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).astype(np.int64))


def _needed(n, percent: int):
    return -(-percent * n // 100)


def document_sets(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document its doc_id, n_shingles, class key and a hash of its text; and rows with a feature that
    may be common, and in n_shingles how many classes of one batch have it."""

    def measured(batches):
        for batch, texts in portions(batches, "text", PARCEL_PORTION):
            ids = batch.column(0)
            sets = [shingles(text, words) for text in texts]
            keys = [class_key(one) for one in sets]
            seen, counts = shared_features.often_seen(list(dict(zip(keys, sets)).values()))
            names = ["doc_id", "n_shingles", "key", "text_hash", "feature"]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(one) for one in sets], pa.int64()), pa.array(keys, pa.int64()), batch.column(2),
                 pa.nulls(len(sets), pa.int64())], names)
            nothing = pa.nulls(len(seen), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(seen), ids.type), pa.array(counts, pa.int64()), nothing, nothing,
                 pa.array(seen.astype(np.int64))], names)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return stored(documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        measured, f"doc_id {id_type}, n_shingles long, key long, text_hash long, feature long"), "sets")


def _parcels(common: np.ndarray, routes: int, words: int):
    """Parcels of shingles, and of classes: a the sorted keys, b their sizes, c how many common shingles
    each has, d these."""

    def sent(batches):
        for _, texts in portions(batches, "text", PARCEL_PORTION):
            sets = {}
            for text in texts:
                one = shingles(text, words)
                if len(one):
                    sets[class_key(one)] = one
            if not sets:
                continue
            keys = np.array(list(sets), np.int64).view(np.uint64)
            order = np.argsort(keys)
            keys, members = keys[order], [list(sets.values())[i] for i in order]
            rows = shared_features.send(keys, members, common, routes)
            known = [one[shared_features.is_in(common, one)] for one in members]
            cuts = np.searchsorted(blobs.bucket(keys, routes), np.arange(routes + 1)).tolist()
            for route, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    rows.append((
                        routes + route, blobs.pack_sorted(keys[a:b]), blobs.pack(np.array([len(one) for one in members[a:b]])),
                        blobs.pack(np.array([len(one) for one in known[a:b]])), blobs.pack(np.concatenate(known[a:b]))))
            yield shared_features.batch_of(rows)

    return sent


def _candidates(percent: int):
    """Per range of classes: those with enough shared shingles, which are in order of list length."""

    def gathered(table: pa.Table) -> pa.Table:
        sizes: dict[int, int] = {}
        parts = []
        for row in table.to_pylist():
            keys = blobs.unpack_sorted(row["a"])
            if row["c"] is None:
                parts.append((keys, blobs.unpack(row["b"]), blobs.unpack(row["d"])))
                continue
            new = np.array([key not in sizes for key in keys.tolist()], bool)
            sizes.update(zip(keys.tolist(), blobs.unpack(row["b"]).tolist()))
            common, counts = blobs.unpack(row["d"]), blobs.unpack(row["c"]).astype(np.int64)
            owner, fresh = np.repeat(keys, counts), np.repeat(new, counts)
            parts.append((owner[fresh], common[fresh], np.full(int(fresh.sum()), 1 << 62, np.uint64)))
        keys, hashes, counts = (np.concatenate(column) for column in zip(*parts))
        out = {"key": [], "n": [], "shared": [], "short": []}
        order = np.lexsort((hashes, counts, keys))
        keys, hashes = keys[order], hashes[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        for a, b in zip(starts, np.r_[starts[1:], len(keys)]):
            key = int(keys[a])
            n = sizes[key]
            needed = _needed(n, percent)
            if b - a >= needed:
                out["key"].append(int(np.uint64(key).astype(np.int64)))
                out["n"].append(n)
                out["short"].append(hashes[a: b - needed + 1].astype(np.int64))
                out["shared"].append(np.sort(hashes[a:b]).tobytes())
        return pa.table(out, pa.schema([
            ("key", pa.int64()), ("n", pa.int64()), ("shared", pa.binary()), ("short", pa.list_(pa.int64()))]))

    return gathered


def _probed(percent: int):
    """Pairs whose sets overlap enough: the sorted set of one is probed for the members of the other."""

    def probed(batches):
        for batch in batches:
            a, b, n_a, n_b, set_a, set_b = (column.to_pylist() for column in batch.columns)
            linked = []
            for place in range(len(a)):
                small, large = sorted((np.frombuffer(set_a[place], np.uint64), np.frombuffer(set_b[place], np.uint64)), key=len)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                if 100 * common >= percent * (n_a[place] + n_b[place] - common):
                    linked.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in linked], pa.int64()), pa.array([b[i] for i in linked], pa.int64())], ["a", "b"])

    return probed


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    left = classes.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("set_a"))
    right = classes.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("set_b"))
    both = pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
    return both.select("a", "b", "n_a", "n_b", "set_a", "set_b").mapInArrow(_probed(percent), "a long, b long")


def _fitting(percent: int):
    """Sizes and places in the order of lists that a linked pair can have at its first common list."""
    least = F.ceil(percent * (F.col("n") + F.col("o_n")) / (100 + percent))
    return (F.least("rest", "o_rest") >= least) & (
        100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n"))


def _linking(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings of the lists that hold two components or more, with the component of each class."""
    known = labels.select(F.col("node").alias("key"), "label")
    labelled = stored(postings.select("key", "list").join(known, "key", "left").select(
        "key", "list", F.coalesce("label", "key").alias("c")), "labelled")
    mixed = labelled.groupBy("list").agg(
        F.min("c").alias("low"), F.max("c").alias("high"), F.min("key").alias("first")).filter("low <> high")
    return stored(labelled.join(mixed.select("list", "first"), "list"), "mixed")


def _cells(open_: DataFrame, classes: DataFrame, cell: int) -> DataFrame:
    """The classes that are still to be compared, dealt to cells.

    Lists that have a class in common make a block.  A block's classes are cut into parts of about
    ``cell`` classes, large components into parts of their own; every two parts make a cell, except two
    parts of one component.
    """
    blocks = components(open_.select(F.col("key").alias("a"), F.col("first").alias("b")))
    members = stored(open_.select("key", "c").distinct().join(
        blocks.select(F.col("node").alias("key"), F.col("label").alias("block")), "key"), "members")
    sizes = members.groupBy("block", "c").agg(F.count("*").alias("size"))
    small = F.when(F.col("size") < cell, F.col("size")).otherwise(0)
    small_sizes = sizes.groupBy("block").agg(F.sum(small).alias("small"))
    parts = lambda size: F.ceil(F.col(size) / cell)
    large = F.col("size") >= cell
    placed = members.join(sizes, ["block", "c"]).join(small_sizes, "block").select(
        "key", "c", "block", F.when(large, F.col("c")).alias("whole"),
        F.when(large, F.xxhash64("c", F.pmod(F.xxhash64("key"), parts("size")))).otherwise(
            F.pmod(F.xxhash64("c"), F.greatest(F.lit(1), parts("small")))).alias("part"))
    known = stored(placed, "parts")
    every = known.select("block", "part", "whole").distinct()
    others = every.select("block", F.col("part").alias("with"), F.col("whole").alias("with_whole"))
    pairs = every.join(others, "block").filter(
        "part <= with AND NOT (whole IS NOT NULL AND whole <=> with_whole)").select(
        "block", "part", "with", F.xxhash64("block", "part", "with").alias("cell"))
    sides = pairs.select("block", "part", "cell", F.when(F.col("part") == F.col("with"), 0).otherwise(1).alias("side")).unionAll(
        pairs.filter("part <> with").select("block", "with", "cell", F.lit(2)))
    return known.join(sides, ["block", "part"]).join(classes.select("key", "n", "shared"), "key").select(
        "cell", "side", "key", "c", "n", "shared")


def divide_skip(lists: list[np.ndarray], needed: int, members: int, weigh: float = WEIGH) -> tuple[np.ndarray, np.ndarray]:
    """Members (places from 0 to ``members``) that occur in ``needed`` of the sorted lists or more, and in how many.

    The longer the longest list, the fewer lists are long: the short ones are merged, which costs
    their length, and the long ones probed for what the merge leaves, which costs its logarithm.
    """
    lists = sorted(lists, key=len)
    if len(lists) < needed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    long = min(needed - 1, int(needed / (weigh * np.log2(len(lists[-1]) + 1) + 1)))
    short = lists[: len(lists) - long]
    count = np.bincount(np.concatenate(short), minlength=members)
    found = np.flatnonzero(count >= max(1, needed - long))
    count = count[found]
    for one in lists[len(lists) - long:]:
        if not len(found):
            break
        at = np.minimum(np.searchsorted(one, found), len(one) - 1)
        count = count + (one[at] == found)
    return found[count >= needed], count[count >= needed]


def _searched(percent: int):
    """Links between different components of one cell, as few as join them."""

    def searched(table: pa.Table) -> pa.Table:
        side, key, n = (table.column(name).to_numpy() for name in ("side", "key", "n"))
        _, root = np.unique(table.column("c").to_numpy(), return_inverse=True)
        sets = [np.frombuffer(one, np.uint64) for one in table.column("shared").to_pylist()]
        indexed = np.flatnonzero(side != 2)
        flat = np.concatenate([sets[i] for i in indexed])
        owner = np.repeat(indexed, [len(sets[i]) for i in indexed])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        values, ends = flat[start], np.r_[start[1:], len(flat)]
        links = []
        for query in np.flatnonzero(side != 1).tolist():
            at = np.minimum(np.searchsorted(values, sets[query]), len(values) - 1)
            at = at[values[at] == sets[query]]
            lists = [owner[a:b] for a, b in zip(start[at].tolist(), ends[at].tolist())]
            found, common = divide_skip(lists, int(_needed(n[query], percent)), len(sets))
            linked = found[100 * common >= percent * (n[query] + n[found] - common)]
            for other in linked.tolist():
                if root[other] != root[query]:
                    links.append((key[query], key[other]))
                    root[root == root[other]] = root[query]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return searched


def linked_components(classes: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """(node, label) of the classes that link to another one."""
    postings = classes.select("key", "n", F.octet_length("shared").alias("bytes"), F.posexplode("short").alias("i", "list"))
    postings = stored(postings.select(
        "key", "n", "list", (F.col("bytes") / 8 - F.col("i")).cast("long").alias("rest")), "postings")
    member = F.struct("key", "n", "rest")
    firsts = postings.groupBy("list").agg(F.min(member).alias("p"), F.count("*").alias("size")).filter("size > 1")
    pairs = postings.join(firsts, "list").select(
        "key", "n", "rest", *[F.col(f"p.{name}").alias(f"o_{name}") for name in ("key", "n", "rest")]
    ).filter(F.col("key") != F.col("o_key")).filter(_fitting(percent)).select(
        F.least("key", "o_key").alias("a"), F.greatest("key", "o_key").alias("b"))
    first = stored(_verified(pairs, classes, percent), "verified")
    cells = _cells(_linking(postings, components(first)), classes, cell)
    rest = stored(cells.groupBy("cell").applyInArrow(_searched(percent), "a long, b long"), "verified")
    return components(first.unionAll(rest))


def _labelled(documents: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their class key, and (node, label) of the classes that link to another one."""
    routes = routes_for(documents)
    sets = document_sets(documents, words)
    ids = sets.filter("feature IS NULL").drop("feature")
    reports = sets.filter("feature IS NOT NULL").select("feature", F.col("n_shingles").alias("owners"))
    common = shared_features.common_features(reports, ids.count())
    parcels = documents.select("text").mapInArrow(_parcels(common, routes, words), PARCEL)
    replies = parcels.groupBy("route").applyInArrow(shared_features.shared(routes), PARCEL)
    classes = stored(replies.groupBy("route").applyInArrow(
        _candidates(percent), "key long, n long, shared binary, short array<long>"), "classes")
    return ids, linked_components(classes, percent, CELL)


def join_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id, the least doc_id that links reach, of every row."""
    ids, labels = _labelled(documents, words, percent)
    first = ids.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    labelled = first.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "label", F.coalesce("label", "key"))
    component = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    named = labelled.select("key", "label").join(component, "label").select("key", "component_id")
    return ids.join(named, "key", "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def first_of_components(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, as it was: that with the least doc_id, nulls last, and the least hash of its text.

    Components are told apart by their label, so rows that share a doc_id and do not link both stay.  Rows
    without shingles, which no other links to, all stay.
    """
    ids, labels = _labelled(documents, words, percent)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = ids.filter("n_shingles > 0").groupBy("key").agg(F.min(row).alias("first"))
    leading = first.join(labels.withColumnRenamed("node", "key"), "key", "left").groupBy(
        F.coalesce("label", "key").alias("label")).agg(F.min("first").alias("first"))
    blank = ids.filter("n_shingles = 0").select("doc_id", "text_hash").distinct()
    chosen = leading.select("first.doc_id", "first.text_hash", F.lit(False).alias("blank")).unionAll(
        blank.withColumn("blank", F.lit(True)))
    # Whole rows travel as one column, so that no name of theirs can clash.
    row = F.struct(*[documents[f"`{name}`"] for name in documents.columns])
    marked = documents.select(row.alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash")).join(
        chosen, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash")))
    # Rows without shingles stand alone; of the copies of others each task keeps one before the shuffle.
    alone = F.when(F.col("blank"), F.monotonically_increasing_id())
    turn = F.row_number().over(Window.partitionBy("own_id", "own_hash", "alone").orderBy("blank"))
    first = marked.withColumn("alone", alone).withColumn("turn", turn).filter("turn = 1")
    return first.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
