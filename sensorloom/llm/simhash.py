"""Document fingerprints by SimHash, and all pairs of them within a Hamming radius.

Terms are single words and runs of two words.  A term votes for or against each bit by the bits of its
128-bit hash, with weight ``1 + ln(count)``, runs of two words with half of that, in thousandths.  The likeness of two
fingerprints is the cosine that their differing bits estimate, not below 0.

For a radius r and m blocks to agree on, the bits are cut into r + m blocks: fingerprints within r bits of each
other agree on m blocks at least.  There is a table for every choice of the first one or two (``lead``) of these
blocks, keyed by their bits; inside a key, fingerprints are compared that agree on m - lead later blocks too, or
all of them where this is less.  A pair counts where its first m agreeing blocks are the ones it is met by.  The
more fingerprints there are, the more blocks have to agree (``agreement``), which changes the cost and not the
result.

Single words changed at random until the Jaccard similarity of five-word shingles is just above 0.75 leave
0.94 or more of the copies of 60, 100, 300 and 1,000 words within 14 bits, which is the radius of the search.

A document's near ones are counted as rows: exact copies of it, and all copies of the fingerprints within
the radius.

Defined results: a null or empty text has no terms and the fingerprint of zero bits; equal texts have equal
fingerprints, so that blank ones are near each other; rows with the same doc_id follow each other by their text; a null doc_id comes last; a single
document is its own next one; no documents give no rows.
"""

from __future__ import annotations

import hashlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.llm.common import partitions, stored

BITS, RADIUS = 128, 3
#: Radius that the query searches.
NEAR = 14
#: Weight of two words against that of a single one.
DOUBLE = 0.5
#: Parts that a weight is rounded to.
UNIT = 1000
#: Fingerprints of one table key that are compared in one task at most.  A key with more is cut into cells.
CELL = 1 << 16
#: Blocks that near fingerprints can be asked to agree on, and the cost of comparing two against sorting one.
AGREEMENTS, COMPARING = range(2, 7), 0.2
#: Pairs whose bits are compared at once.
AT_ONCE = 1 << 18
#: Crowded keys that are broadcast at most; more are joined by a shuffle.
CROWDS = 200_000
#: Parts that the rows of one fingerprint are spread over.
SALTS = 32

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_COLUMN = np.arange(BITS // 8) * 256
#: Vote of each bit of a byte value: -1 or 1.
_VOTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64) * 2 - 1


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _stir(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * factor
    return values ^ (values >> np.uint64(29))


def fingerprint(text: str) -> np.ndarray:
    """16 bytes."""
    words = text.split()
    if not words:
        return np.zeros(BITS // 8, np.uint8)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    single, times = np.unique(hashes, return_counts=True)
    double, both = np.unique(_stir(hashes[:-1], _MIX[0]) + hashes[1:], return_counts=True)
    terms = np.r_[single, double]
    # Whole numbers, whose sums do not depend on the order of terms.
    weights = np.rint(UNIT * np.r_[1 + np.log(times), DOUBLE * (1 + np.log(both))])
    halves = np.stack([_stir(_stir(terms + factor, factor), _MIX[0]) for factor in _MIX], axis=1)
    cells = halves.view(np.uint8).reshape(len(terms), BITS // 8) + _COLUMN
    votes = np.bincount(
        cells.ravel(), np.repeat(weights, BITS // 8), minlength=256 * BITS // 8).reshape(-1, 256) @ _VOTES
    return np.packbits(votes > 0, axis=1).ravel()


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of rows of fingerprints: the cosine of the angle that their differing bits stand for."""
    apart = np.bitwise_count(one ^ other).sum(axis=-1)
    return np.where(apart == 0, 1.0, np.maximum(0.0, np.cos(np.pi * apart / BITS)))


_OUT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _judged(ids: list, texts: list[str], next_texts: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    """The columns of documents whose next document is known."""
    prints: dict[str, np.ndarray] = {}

    def of(text: str) -> np.ndarray:
        if text not in prints:
            prints[text] = fingerprint(text)
        return prints[text]

    edited = [text[: len(text) - len(text) // 3] + after[: len(text) // 3] for text, after in zip(texts, next_texts)]
    own, changed, following = (
        np.array([of(text) for text in part], np.uint8).reshape(-1, BITS // 8) for part in (texts, edited, next_texts))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, id_type), pa.array(map(len, texts), pa.int64()),
        pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited]),
        pa.array(map(bytes, own), pa.binary()), pa.array(map(bytes, changed), pa.binary()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, following))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _in_order(batches):
    """Rows of one partition in order.  All but the last are judged; the first and the last also come out
    with their text, for the neighbours in other partitions."""
    place, held, first = TaskContext.get().partitionId(), None, True

    def edge(row, kind):
        empty = [pa.nulls(1, type_) for type_ in (
            pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0]], id_type), *empty, pa.array([kind]), pa.array([place], pa.int32()), pa.array([row[1]])],
            [*_NAMES, "edge", "place", "text"])

    for batch in batches:
        id_type = batch.schema.field(0).type
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if not ids:
            continue
        if first:
            yield edge((ids[0], texts[0]), "first")
            first = False
        if held:
            ids, texts = [held[0], *ids], [held[1], *texts]
        for a in range(0, len(ids) - 1, 512):
            b = min(a + 512, len(ids) - 1)
            judged = _judged(ids[a:b], texts[a:b], texts[a + 1: b + 1], id_type)
            size = judged.num_rows
            yield pa.RecordBatch.from_arrays(
                [*judged.columns, pa.nulls(size, pa.string()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.string())],
                [*_NAMES, "edge", "place", "text"])
        held = (ids[-1], texts[-1])
    if held:
        yield edge(held, "last")


def _pairs(batches):
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        yield _judged(*columns, batch.schema.field(0).type)


def fingerprints(documents: DataFrame) -> DataFrame:
    """The fingerprint of every text, and of the text whose end gives way to the next document's start.

    One range partitioning by doc_id brings neighbours together; only the two edges of each partition are
    matched afterwards, by a join of their places.
    """
    spark = documents.sparkSession
    id_type = documents.schema["doc_id"].dataType.simpleString()
    order = F.col("doc_id").desc_nulls_last()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The start of the text spreads rows that share a doc_id, or have none.
    dealt = texts.repartitionByRange(partitions(spark), order, F.substring("text", 1, 64)).sortWithinPartitions(order, "text")
    found = stored(dealt.mapInArrow(
        _in_order, f"doc_id {id_type}, {_OUT}, edge string, place int, text string"), "fingerprints")
    firsts = found.filter("edge = 'first'").select("place", F.col("text").alias("next_text"))
    lasts = found.filter("edge = 'last'").select("doc_id", "place", "text")
    # One row per partition, without texts: which partition comes next, and the first after the last.
    around = Window.orderBy("place")
    turns = firsts.select("place").withColumns({
        "after": F.lead("place").over(around), "start": F.min("place").over(Window.partitionBy())})
    following = turns.select("place", F.coalesce("after", "start").alias("next_place"))
    edges = lasts.join(following, "place").join(firsts.withColumnRenamed("place", "next_place"), "next_place")
    closed = edges.select("doc_id", "text", "next_text").mapInArrow(_pairs, f"doc_id {id_type}, {_OUT}")
    return found.filter("edge IS NULL").select(*closed.columns).unionAll(closed)


def agreement(size: int, radius: int, cell: int = CELL) -> tuple[int, int]:
    """For this many fingerprints: the blocks that near ones are asked to agree on, and how many of them
    make the key of a table, so that a key of evenly spread fingerprints fits a cell."""
    def cost(m: int) -> float:
        return comb(radius + m, m) * (1 + COMPARING * size / 2 / 2 ** (BITS * m / (radius + m)))

    m = min(AGREEMENTS, key=cost)
    lead = next((k for k in range(1, m) if size / 2 ** (BITS * k / (radius + m)) <= cell), m - 1)
    return m, lead


def _blocks(count: int) -> list[np.ndarray]:
    return np.array_split(np.arange(BITS), count)


def _block_keys(bits: np.ndarray, count: int) -> np.ndarray:
    """Rows of bits to the number that each block's bits make."""
    return np.stack([
        bits[:, block].astype(np.int64) @ (np.int64(1) << np.arange(len(block), dtype=np.int64)) for block in _blocks(count)],
        axis=1)


def _joint(keys: np.ndarray, chosen: tuple[int, ...]) -> np.ndarray:
    """One number for the bits of the chosen blocks.  Where they are more than 64, others may get the same."""
    width, joint = -(-BITS // keys.shape[1]), np.zeros(len(keys), np.int64)
    for block in chosen:
        joint = (joint << np.int64(width)) + keys[:, block]
    return joint


def _bits(raw: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BITS // 8), axis=1)


def _keys(radius: int, m: int, lead: int):
    """Each fingerprint with its key in every table."""

    def keyed(batches):
        tables = list(combinations(range(radius + m), lead))
        for batch in batches:
            raw, copies = batch.column(0), batch.column(1)
            if not len(raw):
                continue
            keys = _block_keys(_bits(raw.to_pylist()), radius + m)
            for table, chosen in enumerate(tables):
                if chosen[-1] <= radius + lead - 1:  # later blocks are too few to agree on the rest
                    yield pa.RecordBatch.from_arrays(
                        [raw, copies, pa.array(np.full(len(raw), table, np.int32)), pa.array(_joint(keys, chosen))],
                        ["fingerprint", "copies", "table", "key"])

    return keyed


def near_pairs(prints: np.ndarray, table: tuple[int, ...], sides: np.ndarray, radius: int, m: int):
    """Portions (i, j, apart) of the pairs of one cell within the radius whose first agreeing blocks are the
    table's.  Rows of side 0 pair with each other, rows of side 1 with those of side 2."""
    words = np.ascontiguousarray(prints).view(np.uint64)
    size, count, lead = len(words), radius + m, len(table)
    masks = np.zeros((count, BITS), np.uint8)
    for block, places in enumerate(_blocks(count)):
        masks[block, places] = 1
    masks = np.packbits(masks, axis=1).view(np.uint64)

    def judged(i: np.ndarray, j: np.ndarray, first: tuple[int, ...]):
        """The near ones of pairs, where they agree on the blocks ``first`` and on no others up to the last."""
        apart = words[i] ^ words[j]
        far = np.bitwise_count(apart[:, 0]).astype(np.int64) + np.bitwise_count(apart[:, 1])
        near = np.flatnonzero((far <= radius) & ((sides[i] != sides[j]) | (sides[i] == 0)))
        agreeing = ((apart[near][:, None, :] & masks[None, : first[-1] + 1]) == 0).all(axis=2)
        near = near[(agreeing == np.isin(np.arange(first[-1] + 1), first)).all(axis=1)]
        return i[near], j[near], far[near]

    keys = _block_keys(np.unpackbits(prints, axis=1), count)
    rest = list(combinations(range(table[-1] + 1, count), m - lead))

    def groups(chosen):
        joint = _joint(keys, chosen)
        order = np.argsort(joint)
        ordered = joint[order]
        start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        return order, start, np.diff(np.r_[start, size])

    # Comparing all pairs costs less than sorting in small cells, and than meeting again and again in groups of copies.
    every, met = size * (size - 1) // 2, 0
    whole = COMPARING * every <= len(rest) * size
    for chosen in () if whole else rest:
        sizes = groups(chosen)[2]
        met += int((sizes * (sizes - 1)).sum()) // 2
        whole = met >= every
        if whole:
            break
    if whole:
        at = 0
        while at < size - 1:
            some = min(size - 1 - at, max(1, AT_ONCE // size))
            i, j = np.nonzero(np.arange(size - at) > np.arange(some)[:, None])
            yield judged(i + at, j + at, table)
            at += some
        return
    for chosen in rest:
        order, start, sizes = groups(chosen)
        ends = np.repeat(start + sizes, sizes)
        active, step = np.arange(size), 1
        while len(active := active[active + step < ends[active]]):
            for at in range(0, len(active), AT_ONCE):
                part = active[at: at + AT_ONCE]
                yield judged(order[part], order[part + step], (*table, *chosen))
            step += 1


def _cells(batches):
    """The rows of each cell, which come one after another."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.stack([batch.column(name).to_numpy() for name in ("table", "key", "cell")], axis=1).astype(np.int64)
        cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts, cuts[1:]):
            here = tuple(cells[a])
            if held and held[0] != here:
                yield pa.Table.from_batches(held[1])
                held = []
            held = held or [here, []]
            held[1].append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held[1])


def _met(radius: int, m: int, lead: int):
    """Per cell the pairs within the radius, with the rows of the cell: (cell, portions)."""

    def met(batches):
        tables = list(combinations(range(radius + m), lead))
        for cell in _cells(batches):
            if cell.num_rows > 1:
                prints = np.frombuffer(b"".join(cell.column("fingerprint").to_pylist()), np.uint8).reshape(-1, BITS // 8)
                yield cell, near_pairs(
                    prints, tables[cell.column("table")[0].as_py()], cell.column("side").to_numpy(), radius, m)

    return met


def _counted(met):
    """Per cell: how many rows of others of the cell are near."""

    def counted(batches):
        for cell, portions in met(batches):
            copies = cell.column("copies").to_numpy()
            count = np.zeros(len(copies), np.int64)
            for i, j, _ in portions:
                np.add.at(count, i, copies[j])
                np.add.at(count, j, copies[i])
            found = np.flatnonzero(count)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [cell.column("fingerprint").take(found).combine_chunks(), pa.array(count[found])], ["fingerprint", "n"])

    return counted


def _linked(met):
    def linked(batches):
        for cell, portions in met(batches):
            prints = cell.column("fingerprint").combine_chunks()
            for i, j, apart in portions:
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [prints.take(pa.array(i)), prints.take(pa.array(j)), pa.array(apart)], ["a", "b", "apart"])

    return linked


def members(prints: DataFrame) -> DataFrame:
    """(fingerprint, copies): the distinct fingerprints and the number of their rows."""
    return prints.groupBy("fingerprint").agg(F.count("*").alias("copies"))


def _dealt(distinct: DataFrame, radius: int, m: int, lead: int, cell: int) -> DataFrame:
    """The fingerprints in every cell where they are compared, cells together and in order.

    A key with more fingerprints than fit a cell is cut into parts by hash, and every two parts make a
    cell of their own, so that no task holds more than two parts and no pair is left out.
    """
    spark = distinct.sparkSession
    keyed = distinct.mapInArrow(_keys(radius, m, lead), "fingerprint binary, copies long, table int, key long")
    crowds = stored(keyed.groupBy("key", "table").agg(F.count("*").alias("size")).filter(
        F.col("size") > cell).select("key", "table", F.ceil(F.col("size") / cell).cast("int").alias("parts")), "crowds")
    if crowds.count() <= CROWDS:
        crowds = F.broadcast(crowds)
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    # The cells of a part: with itself (side 0), and with each other part (side 1 as the smaller one).
    low, high = F.least("part", "with"), F.greatest("part", "with")
    parted = keyed.join(crowds, ["key", "table"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", part).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = parted.select(
        "fingerprint", "copies", "table", "key", (low * F.col("parts") + high).cast("long").alias("cell"),
        F.when(low == high, 0).when(F.col("part") == low, 1).otherwise(2).alias("side"))
    return cells.repartition(partitions(spark), "table", "key", "cell").sortWithinPartitions("table", "key", "cell")


def _searched(distinct: DataFrame, radius: int, cell: int, agreeing: tuple[int, int] | None, result, schema: str) -> DataFrame:
    m, lead = agreeing or agreement(distinct.count(), radius, cell)
    return _dealt(distinct, radius, m, lead, cell).mapInArrow(result(_met(radius, m, lead)), schema)


def near_links(
    prints: DataFrame, radius: int = NEAR, cell: int = CELL, agreeing: tuple[int, int] | None = None,
) -> DataFrame:
    """(a, b, apart): every two distinct fingerprints within the radius, once.  With ``members`` these are
    all near rows; there are as many links as pairs, so a large group of near copies has very many."""
    return _searched(stored(members(prints), "members"), radius, cell, agreeing, _linked, "a binary, b binary, apart long")


def near_counts(
    prints: DataFrame, radius: int = RADIUS, cell: int = CELL, agreeing: tuple[int, int] | None = None,
) -> DataFrame:
    """(fingerprint, n_near): how many other rows, copies among them, lie within the radius, where any do."""
    distinct = stored(members(prints), "members")
    found = _searched(distinct, radius, cell, agreeing, _counted, "fingerprint binary, n long")
    copies = distinct.filter("copies > 1").select("fingerprint", (F.col("copies") - 1).alias("n"))
    return found.unionAll(copies).groupBy("fingerprint").agg(F.sum("n").alias("n_near"))


def with_near_counts(prints: DataFrame, radius: int = NEAR, salts: int = SALTS) -> DataFrame:
    """The rows with ``n_near``.  Rows of one fingerprint, which may be many, are spread over the salts."""
    near = near_counts(prints, radius).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = prints.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(salts)).cast("int"))
    return salted.join(near, ["fingerprint", "_salt"], "left").drop("_salt").withColumn(
        "n_near", F.coalesce("n_near", F.lit(0)))
