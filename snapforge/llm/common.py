"""Helpers shared by the training-data operators: sizes, files, column plumbing."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import remove, scratch, stage, unstage  # noqa: F401  (for the operators)

ID, TEXT = "doc_id", "text"
#: Bytes of input, as its files hold it, that one task should handle when an operator deals rows out anew.
TASK_BYTES = 64 << 20


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of df's input by the optimiser's estimate of its size; None where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def tasks_for(df: DataFrame, each: int = TASK_BYTES) -> int:
    """How many tasks df's input is worth; 1 where its size isn't known."""
    return max(1, min(-(-(input_bytes(df) or 0) // each), 200_000))


def in_few_tasks(df: DataFrame, source: DataFrame) -> DataFrame:
    """df in as many tasks as run at once, or as source's input is worth if that is more, so that few rows leave few files; as it is where that size isn't known."""
    return df if input_bytes(source) is None else df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, tasks_for(source)))


def open_fs(path: str):
    """(pyarrow file system, path in it) for a shared folder's URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


def id_text(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """Just the key and the text, under fixed names; other columns, whatever their names, play no part."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(ID), F.col(f"`{text_col}`").cast("string").alias(TEXT))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and everything else kept."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


_HELD: dict = {}


def held_by_worker(key, make):
    """make()'s result, kept in this Python worker until another key is asked for, so that one operator's memory at most outlives its tasks."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]
