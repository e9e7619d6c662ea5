"""Pieces shared by the training-data operators.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]`` everywhere in this
subpackage.  An operator selects the columns that it needs by name, so further columns of
its input, whatever their names, never meet its own.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = 2**63 - 1  # stands for a null id inside operators: larger than any other
SLICE_BYTES = 4 << 20  # text bytes that a Python stage handles at once (one longer text: alone)


KEPT: dict[str, object] = {}  # what a worker process keeps from one task of a stage to the next


def let_go() -> None:
    """Drop what stages before this one have kept in this worker."""
    if KEPT:
        KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def column(df: DataFrame, name: str) -> Column:
    """The column of that name, also when it holds a dot."""
    return df[f"`{name}`"]


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add ``name``: the gapless position, from 0, of each row in the total order ``order``.

    A range sort spreads the rows (a hot key too, if ``order`` goes on with a unique column);
    each partition's base is the prefix sum of the counts before it, a table of one row a
    partition.  The sorted rows are stored, so a lost executor cannot renumber them.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (stored.withColumn("_part", part).join(F.broadcast(bases), "_part")  # a row a partition
            .withColumn(name, F.col("_base") + F.col("_at") - F.shiftleft(F.col("_part"), 33))
            .drop("_at", "_part", "_base"))


def slices(sizes: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) whose sizes sum to ``limit`` at most, or that hold a single row."""
    ends = np.cumsum(sizes)
    a, base = 0, 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield a, b
        a, base = b, int(ends[b - 1])


def text_slices(batches, text: str = "text", limit: int = SLICE_BYTES):
    """(slice of the record batch, its texts with null as empty) with bounded text bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, limit):
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the number of words of each text."""
    # the library's ASCII white space is exactly [\x20\x09-\x0D]; ends give empty strings
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    parents = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    counts = np.bincount(parents[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return flat.filter(full), counts.astype(np.int64)


def codes_of(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's code, and the distinct words by code."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def own_rows(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ..., and ``_row``: a number that is each row's own.

    Ids may repeat or be null.  The rows are stored, so every use of them sees the same numbers.
    """
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return materialize(named.withColumn("_row", F.monotonically_increasing_id()), "rows")


def kept_rows(stored: DataFrame, kept: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``stored`` (``own_rows`` of ``docs``) whose number is in ``kept``, under their own names."""
    return stored.join(kept, "_row", "left_semi").drop("_row").toDF(*docs.columns)
