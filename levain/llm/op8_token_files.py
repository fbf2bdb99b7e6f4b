"""Token ids as Parquet list columns, for selective reads of tokens and metadata.

Files.  One row a document in ascending id order: ``part``, the id, chosen metadata columns,
``offset``, ``n_tokens`` and ``ids`` (a list of 32-bit integers, the end id last).  Ids are dictionary encoded while a row
group's dictionary fits, else delta encoded (Parquet's version 2 pages); the other numbers are
delta encoded.  Row groups and pages have set sizes, and the writer leaves column and offset
indexes, so a reader that asks for some ids touches only the pages that hold them, and one that
asks for metadata never reads tokens.

Order.  Rows are dealt by ranges of (id, hash of the text) and sorted within each range; ``part`` is
the range's number and ``offset`` the number of ids before the row in its part.  The place of a
document's first token among all is then its offset and the sum of the parts before (a table of as
many rows as there are parts).

Cases.  A null or empty text holds the end id alone.  Null ids come first.  Rows with the same id
are ordered by a hash of their text; equal rows are kept.  Metadata columns that clash with the
file's own names are refused.  An empty table gives empty files and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levain.llm.common import scratch, prepare
from levain.llm.tokens import default_path, encoder

#: The id appended to each document.
END_ID = 1
OWN = ("part", "offset", "n_tokens", "ids")
#: Writer settings; a row group holds about 4 million tokens, a page about 256 thousand.
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true", "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(1 << 20), "parquet.page.row.count.limit": "1024", "parquet.dictionary.page.size": str(1 << 20), "compression": "zstd",
}


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = (),
          tokenizer_path: str | None = None, end_id: int | None = END_ID) -> None:
    """Encode every whole text and write the files below ``path``, in ascending order of ``id_col``."""
    if clash := {id_col, *meta_cols} & {*OWN}:
        raise ValueError(f"columns with the file's own names: {sorted(clash)}")
    prepare(docs.sparkSession)
    vocabulary = tokenizer_path or default_path()
    keep = [id_col, *meta_cols]
    rows = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).withColumn("__tie", F.xxhash64("__text"))
    order = [F.col(id_col).asc_nulls_first(), F.col("__tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("__tie")
    fields = ["part", *keep]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before = encoder(vocabulary), 0  # a task holds one part, in order
        for x in batches:
            flat, ends = enc.flat(x.column("__text").to_pylist())
            if end_id is not None:
                flat, ends = np.insert(flat, ends[1:], end_id), ends + np.arange(len(ends))
            ends = ends.astype("int32")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view("<i4")))
            yield pa.record_batch([*(x.column(c) for c in fields), pa.array(before + ends[:-1].astype("int64")), pa.array(np.diff(ends).astype("int64")), ids], [*fields, "offset", "n_tokens", "ids"])
            before += int(ends[-1])

    rows.mapInArrow(tokens, f"{_ddl(rows.select(*fields))}, offset long, n_tokens long, ids array<int>").write.options(**FORMAT).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; select what is needed, and filter by id to read only the pages that hold it."""
    return spark.read.parquet(path)


def located(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``files`` with ``start``, the number of ids of all documents before each; reads no tokens for it."""
    per_part = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a file
    return files.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("offset")).drop("before")


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` with ``ids_crc32`` in place of ``ids``: the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    kept = rows.drop("ids").columns

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ids = x.column("ids")
            flat, at = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            found = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch([*(x.column(c) for c in kept), pa.array(found, pa.int64())], [*kept, "ids_crc32"])

    return rows.select(*kept, "ids").mapInArrow(crc, f"{_ddl(rows.select(*kept))}, ids_crc32 long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` to a new path in the shared folder and read the files back."""
    spark = docs.sparkSession
    path = scratch(spark, "token-files")
    write(docs, path, id_col, text_col, tokenizer_path=tokenizer_path)
    return read(spark, path)
