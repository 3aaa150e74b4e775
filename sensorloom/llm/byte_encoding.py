"""Byte-level BPE encoding of whole texts by overlapping chunks, and decoding.

Texts over one chunk are cut into overlapping chunks that are split into pre-tokens in parallel.  A
chunk's pre-tokens hold from the first boundary that the text before it also has: the split pattern
looks only forward, so equal boundaries are followed by equal pre-tokens.  Where an overlap has no
common boundary the text between is split again from the last sure boundary.  The stitched pieces are
encoded, and decoding joins the bytes of the ids.

Defined results: a null or empty text has no ids and decodes to no bytes; strings of special tokens are
ordinary text; repeated rows are encoded one by one, and need no distinct ids; no documents give no rows.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sensorloom.llm import bpe
from sensorloom.llm.arrow_rows import columns_of, portions
from sensorloom.llm.common import stored

CHUNK, OVERLAP = 1 << 16, 1 << 9
#: A pre-token is sure when so many characters after its end were visible.
LOOKAHEAD = 3
_ROW = "__row"


def chunk_starts(length: int, chunk: int = CHUNK) -> range:
    return range(0, max(length, 1), chunk)


def chunk_ends(chunk_text: str) -> list[int]:
    """Ends of a chunk's pre-tokens, from its start."""
    return [match.end() for match in bpe.SPLIT.finditer(chunk_text)]


def stitch(text: str, ends: list[list[int]], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Pre-tokens of the text from those of its chunks, whose ends count from each chunk's start."""
    cuts, sure = [0], 0
    for place, own in enumerate(ends):
        start = place * chunk
        visible = min(len(text), start + chunk + overlap)
        own = [0, *own]
        # Split from the last sure boundary until a boundary of this chunk is met.
        scan = bpe.SPLIT.finditer(text, sure) if sure != start else iter(())
        at = sure
        while at < start or own[bisect.bisect_left(own, at - start) % len(own)] != at - start:
            following = next(scan, None)
            if following is None:
                break
            at = following.end()
            cuts.append(at)
        for end in own[bisect.bisect_right(own, at - start):]:
            if start + end + LOOKAHEAD > visible and visible < len(text):
                break
            cuts.append(start + end)
        sure = cuts[-1]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def _encoded(lists: list[list[str]], path: str) -> tuple[pa.Array, np.ndarray]:
    """ListArray of the ids of each list of pre-tokens."""
    vocabulary = bpe.load(path)
    pieces, sizes = bpe.flattened(lists)
    slots = vocabulary.slots(pieces)
    counts = bpe.sums(vocabulary.lengths[slots], sizes)
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vocabulary.gather(slots), pa.int32()))


def encode(documents: DataFrame, path: str, text: str = "text", into: str = "ids", chunk: int = CHUNK,
           overlap: int = OVERLAP) -> DataFrame:
    """The rows with the ids of their text in the column ``into``; the text is dropped."""
    kept = [field for field in documents.schema.fields if field.name not in (text, into)]
    schema = T.StructType([*kept, T.StructField(into, T.ArrayType(T.IntegerType()))])
    names = [field.name for field in kept]
    plain = documents.select(*[f"`{name}`" for name in names], F.coalesce(documents[text], F.lit("")).alias("__text"))

    def whole(batches):
        """Texts of one chunk: all their boundaries are sure."""
        for batch, texts in portions(batches, "__text"):
            ids = _encoded([bpe.SPLIT.findall(one) for one in texts], path)
            yield pa.RecordBatch.from_arrays([*columns_of(batch, names), ids], [*names, into])

    def split(batches):
        for batch, texts in portions(batches, "__chunk"):
            yield batch.append_column("__ends", pa.array([chunk_ends(one) for one in texts], pa.list_(pa.int32())))

    def stitched(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__place")
        whole_text = "".join(part[:chunk] for part in rows.column("__chunk").to_pylist())
        ids = _encoded([stitch(whole_text, rows.column("__ends").to_pylist(), chunk, overlap)], path)
        return rows.slice(0, 1).select(names).append_column(into, ids)

    one = F.length("__text") <= chunk
    short = plain.filter(one).mapInArrow(whole, schema)
    places = F.sequence(F.lit(0), F.floor((F.length("__text") - 1) / chunk).cast("int"))
    # A row id tells repeated rows apart.  The chunks are stored with it, since a task that runs again
    # could number its rows anew.
    chunks = stored(
        plain.filter(~one).withColumn(_ROW, F.monotonically_increasing_id())
        .withColumn("__place", F.explode(places))
        .withColumn("__chunk", F.substring("__text", F.col("__place") * chunk + 1, F.lit(chunk + overlap)))
        .drop("__text"), "chunks")
    chunk_schema = T.StructType([*chunks.schema.fields, T.StructField("__ends", T.ArrayType(T.IntegerType()))])
    long = chunks.mapInArrow(split, chunk_schema).groupBy(_ROW).applyInArrow(stitched, schema)
    return short.unionByName(long)


def _some_ids(batch: pa.RecordBatch, ids: str, size: int = 1 << 17):
    """Runs of rows with about so many ids."""
    lists = batch.column(batch.schema.get_field_index(ids))
    group = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    cuts = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)].tolist() if len(group) else [0]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids in the binary column ``into``."""
    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != into], T.StructField(into, T.BinaryType())])

    def joined(batches):
        vocabulary = bpe.load(path)
        for batch in (part for one in batches for part in _some_ids(one, ids)):
            lists = batch.column(batch.schema.get_field_index(ids))
            raw, sizes = vocabulary.raw(lists.flatten().to_numpy(zero_copy_only=False))
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(bpe.sums(sizes, counts))].astype(np.int32)
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([*columns_of(batch, schema.names[:-1]), binary], schema.names)

    return encoded.mapInArrow(joined, schema)
