"""Token counts of whole texts by a .json byte-level vocabulary.

Defined results: a null or empty text has no tokens; the strings of special tokens inside a text count
as one token each, as the tokenizer's library counts them by default; repeated rows are counted one by
one; no documents give no rows; other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from sensorloom.llm import bpe
from sensorloom.llm.arrow_rows import columns_of, portions


def counts(texts: list[str], path: str) -> np.ndarray:
    """Number of tokens of each text."""
    vocabulary = bpe.load(path)
    special = vocabulary.specials
    pieces, sizes = bpe.flattened([vocabulary.parts(text) for text in texts])
    lengths = vocabulary.lengths_of([("" if piece in special else piece) for piece in pieces])
    if any(one in text for text in texts for one in special):
        lengths = np.where(np.fromiter((piece in special for piece in pieces), bool, len(pieces)), 1, lengths)
    return bpe.sums(lengths, sizes)


def count_tokens(documents: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """The rows with the number of tokens of their text in the column ``into``; the text is dropped."""
    kept = [field for field in documents.schema.fields if field.name not in (text, into)]
    schema = T.StructType([*kept, T.StructField(into, T.LongType())])

    def counted(batches):
        for batch, texts in portions(batches, "__text"):
            yield pa.RecordBatch.from_arrays(
                [*columns_of(batch, schema.names[:-1]), pa.array(counts(texts, path), pa.int64())], schema.names)

    return documents.select(*[f"`{field.name}`" for field in kept], documents[text].alias("__text")).mapInArrow(
        counted, schema)
