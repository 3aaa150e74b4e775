"""Which features of a document other documents have too, found with packed shuffles.

Features are 56-bit hashes.  Every task sends the features of its batch to ranges of hash values, in one
row per range, and each range sends back to the owners the features that at least two owners have.
Features that very many documents have are known beforehand and not sent.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm import blobs

BITS = 56
#: A feature counts as common when one of so many documents has it, and at least COMMON_LEAST do.
COMMON, COMMON_LEAST = 1024, 64
#: Parts of a range of features that are worked on one after the other, to bound memory.
SLICES = 8
PARCEL = "route int, a binary, b binary, c binary, d binary"
PARCEL_FIELDS = pa.schema([("route", pa.int32()), *[(name, pa.binary()) for name in "abcd"]])

#: Owners of a batch: sorted 64-bit keys and the sorted distinct features of each.
Owners = Callable[[pa.RecordBatch], tuple[np.ndarray, list[np.ndarray]]]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, PARCEL_FIELDS)], schema=PARCEL_FIELDS)


def often_seen(members: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features that so many owners of one batch have that they may be common, and how many do.

    A common feature has half its owners or more in batches that report it.
    """
    if not members:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seen, counts = np.unique(np.concatenate(members), return_counts=True)
    often = counts >= max(2, len(members) // (2 * COMMON))
    return seen[often], counts[often]


def common_features(reports: DataFrame, documents: int) -> np.ndarray:
    """Sorted common features from reports (feature, owners).

    At most COMMON times the mean number of features per document can be common, however many there are.
    """
    least = max(COMMON_LEAST, documents // COMMON)
    found = reports.groupBy("feature").agg(F.sum("owners").alias("owners")).filter(F.col("owners") >= least)
    return np.sort(np.array([row["feature"] for row in found.collect()], np.uint64))


def common_with_least(reports: DataFrame, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the least of the numbers that the reports give for each feature, as 64-bit features."""
    least = max(COMMON_LEAST, documents // COMMON)
    found = reports.groupBy("feature").agg(F.sum("owners").alias("owners"), F.min("least").alias("least")).filter(
        F.col("owners") >= least).collect()
    features = np.array([row["feature"] for row in found], np.int64).view(np.uint64)
    order = np.argsort(features)
    return features[order], np.array([row["least"] for row in found], np.int64)[order]


def is_in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def send(keys: np.ndarray, members: list[np.ndarray], common: np.ndarray, routes: int) -> list[tuple]:
    """One parcel per range of features: a their values, b the place of the owner among c, the owners."""
    flat = np.concatenate(members)
    owner = np.repeat(np.arange(len(keys)), [len(one) for one in members])
    rare = ~is_in(common, flat)
    flat, owner = flat[rare], owner[rare]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    cuts = np.searchsorted(blobs.bucket(flat, routes, BITS), np.arange(routes + 1))
    rows = []
    for route in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[route], cuts[route + 1])
        who, index = np.unique(owner[part], return_inverse=True)
        rows.append((route, blobs.pack_sorted(flat[part]), blobs.pack(index), blobs.pack_sorted(keys[who]), None))
    return rows


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    fresh = np.zeros(len(columns[0]), bool)
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    fresh[:1] = True
    return fresh


def _several(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of two owners or more, once for each owner, and how many owners each has."""
    order = np.argsort(hashes, kind="stable")
    hashes, keys = hashes[order], keys[order]
    start = _starts(hashes)
    several = ~(start & np.r_[start[1:], True])
    hashes, keys = hashes[several], keys[several]
    order = np.lexsort((keys, hashes))
    hashes, keys = hashes[order], keys[order]
    fresh = _starts(hashes, keys)
    hashes, keys = hashes[fresh], keys[fresh]
    sizes = np.diff(np.r_[np.flatnonzero(_starts(hashes)), len(hashes)])
    counts = np.repeat(sizes, sizes)
    return hashes[counts > 1], keys[counts > 1], counts[counts > 1]


def shared(routes: int):
    """For one range: parcels with the features of two owners or more, for each range of owners.

    a the sorted owners, b their features, d how many owners each feature has.  Parcels of routes from
    ``routes`` on pass as they are.
    """

    def reduced(table: pa.Table) -> pa.Table:
        if table.column("route")[0].as_py() >= routes:
            return table
        sent = [
            (blobs.unpack_sorted(a), blobs.unpack_sorted(c)[blobs.unpack(b).astype(np.int64)])
            for a, b, c in zip(*(table.column(name).to_pylist() for name in "abc"))]
        low, high = (edge(values[place] for values, _ in sent) for edge, place in ((min, 0), (max, -1)))
        steps = np.linspace(float(low), float(high), SLICES + 1)[1:-1].astype(np.uint64)
        cuts = [[0, *np.searchsorted(values, steps).tolist(), len(values)] for values, _ in sent]
        found = [
            _several(*(np.concatenate([part[cut[i]: cut[i + 1]] for part, cut in zip(column, cuts)])
                       for column in zip(*sent)))
            for i in range(SLICES)]
        hashes, keys, counts = map(np.concatenate, zip(*found))
        order = np.argsort(keys, kind="stable")
        hashes, keys, counts = hashes[order], keys[order], counts[order]
        cuts = np.searchsorted(blobs.bucket(keys, routes), np.arange(routes + 1))
        rows = []
        for to in np.flatnonzero(np.diff(cuts)).tolist():
            part = slice(cuts[to], cuts[to + 1])
            rows.append((routes + to, blobs.pack_sorted(keys[part]), blobs.pack(hashes[part]), None,
                         blobs.pack(counts[part])))
        return pa.Table.from_batches([batch_of(rows)])

    return reduced
