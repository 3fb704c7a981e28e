"""Helpers shared by the corpus operators: the shared folder, written tables, text rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local session may leave that unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it from there; cuts the lineage."""
    folder = shared_folder(df.sparkSession, label)
    df.write.option("compression", codec).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_crc(column: str) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def bounded(batches: Iterable, most: int = 4 << 20, column: int | str = "text") -> Iterator:
    """Cut Arrow batches into slices of about ``most`` text bytes; one long text stays whole."""
    for batch in batches:
        texts = batch.column(column)
        size, begin, rows = 0, 0, batch.num_rows
        if texts.nbytes <= most or rows <= 1:
            yield batch
            continue
        import pyarrow.compute as pc

        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > most:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if begin < rows:
            yield batch.slice(begin)
