"""Token-ID files (operator 4): flat unsigned ids, 64-bit offsets, memory-mapped reading.

Documents are range-sorted by id; each partition writes three files, in ascending id order:

- ``part-N.ids``: all ids, unsigned, 16 bits where the vocabulary allows it, else 32;
- ``part-N.offsets``: unsigned 64-bit, one more than documents, counted within the part;
- ``part-N.docs``: signed 64-bit document ids (the smallest value stands for null).

``index`` (Parquet, a row a part) has each part's place in the whole: prefix sums of the
documents and ids before it.  All numbers are little-endian.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_dir
from . import tokens
from .common import column, text_slices

NULL_ID = -(2**63)
_PART = pa.schema([("part", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())])
_READ_IDS = 1 << 22  # ids that a reader holds at once (one longer document: alone)


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _writer(folder: str, vocabulary: str, end_id: int):
    def write(batches):
        with tokens.encoder(vocabulary) as encode:
            yield from encoded(batches, encode)

    def encoded(batches, encode):
        from pyspark import TaskContext

        dtype = "<u2" if encode.size <= 1 << 16 else "<u4"
        end, part = np.array([end_id], dtype).tobytes(), TaskContext.get().partitionId()
        fs, at = _files(folder)
        own = f"{at}/.attempt-{uuid.uuid4().hex}"  # renamed when whole: a lost attempt leaves no part
        out, n_docs, n_tokens = None, 0, 0
        for rows, texts in text_slices(batches):
            if out is None:
                fs.create_dir(at, recursive=True)
                out = {k: fs.open_output_stream(f"{own}.{k}") for k in ("ids", "offsets", "docs")}
                out["offsets"].write(np.zeros(1, "<u8").tobytes())
            ids = [np.frombuffer(x, "<u4") for x in encode(texts.to_pylist())]
            out["ids"].write(b"".join([x for d in ids for x in (d.astype(dtype).tobytes(), end)]))
            ends = n_tokens + np.cumsum([len(d) + 1 for d in ids])
            out["offsets"].write(ends.astype("<u8").tobytes())
            out["docs"].write(rows.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, n_tokens = n_docs + len(ids), int(ends[-1])
        if out:
            for k, f in out.items():
                f.close()
                fs.move(f"{own}.{k}", f"{at}/part-{part:06d}.{k}")
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "n_docs": [n_docs], "n_tokens": [n_tokens], "width": [np.dtype(dtype).itemsize]}, _PART)
    return write


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary: str = tokens.WORD_BPE,
                      end_id: int = tokens.END_ID, doc_id: str = "doc_id", text: str = "text") -> str:
    """Write the files of ``docs`` and return their folder (by default a new one in the shared scratch folder).

    A null or empty text is its end id alone.  Null ids come first and are read as null; rows
    that repeat an id are all written, in the order of a hash of their texts.  An empty table gives an index without rows.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-files")
    rows = docs.select(F.coalesce(column(docs, doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       column(docs, text).cast("string").alias("text"))
    # rows of one id (all that have none) are spread and ordered by their texts; equal rows are alike
    order = [F.col("doc_id"), F.xxhash64("text"), F.length("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = ranged.mapInArrow(_writer(folder, vocabulary, end_id), "part long, n_docs long, n_tokens long, width int")
    parts.write.parquet(f"{folder}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    index = spark.read.parquet(f"{folder}/parts")
    index.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
                        for c in ("n_docs", "n_tokens")]).write.parquet(f"{folder}/index")
    return folder


def _open(fs: pafs.FileSystem, path: str):
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)


def read_part(folder: str, part: int, width: int, n_docs: int):
    """(document ids, offsets within the part, ids) of blocks of documents, from the mapped files."""
    fs, at = _files(folder)
    ids, offsets, docs = (_open(fs, f"{at}/part-{part:06d}.{k}") for k in ("ids", "offsets", "docs"))
    step, a = 1 << 16, 0
    while a < n_docs:
        off = np.frombuffer(offsets.read_at(8 * (min(step, n_docs - a) + 1), 8 * a), "<u8").astype(np.int64)
        n = max(1, int(np.searchsorted(off, off[0] + _READ_IDS, side="right")) - 1)
        off = off[:n + 1]
        yield (np.frombuffer(docs.read_at(8 * n, 8 * a), "<i8"), off,
               np.frombuffer(ids.read_at(width * int(off[-1] - off[0]), width * int(off[0])), f"<u{width}"))
        a += n


def _reader(folder: str):
    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for docs, off, ids in read_part(folder, r["part"], r["width"], r["n_docs"]):
                    raw, at = memoryview(ids.astype("<u4").tobytes()), 4 * (off - off[0])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(docs, mask=docs == NULL_ID),
                        pa.array(r["n_tokens_before"] + off[:-1]), pa.array(np.diff(off)),
                        pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64()),
                    ], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    index = spark.read.parquet(f"{folder}/index")
    parts = index.repartition(max(1, index.count()), "part")
    return parts.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
