"""Snapshots, reports and the run's state on any file system that Spark reaches."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: pandas' markers of a missing cell, which a sheet of strings reads as empty.
MISSING = "#N/A|#N/A N/A|#NA|-1.#IND|-1.#QNAN|-NaN|-nan|1.#IND|1.#QNAN|<NA>|N/A|NA|NULL|NaN|None|n/a|nan|null".split("|")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def load_sheet(spark: SparkSession, path: str, na_markers: bool = False) -> DataFrame:
    """A Parquet or CSV sheet with all columns as strings but ord; FileNotFoundError where there is none."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.option("header", True).csv(path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    value = lambda c: F.when(F.col(f"`{c}`").isin(*MISSING), None).otherwise(F.col(f"`{c}`").cast("string")) if na_markers else F.col(f"`{c}`").cast("string")
    return df.select(*(F.col("ord").cast("long") if c == "ord" else value(c).alias(c) for c in df.columns))


def read_excel(spark: SparkSession, path: str, sheet_name: str) -> DataFrame:
    """An Excel sheet, small enough for the driver, where pandas has an engine for it; ord is the row's place."""
    import pandas as pd

    told = pd.read_excel(path, sheet_name=sheet_name, dtype=str)
    return spark.createDataFrame(told.assign(ord=range(len(told))))


def snapshot_name(at: datetime, prefix: str = "Certificates") -> str:
    return f"{prefix}_{at:%d.%m.%Y_%H.%M}"


def write_snapshot(df: DataFrame, base: str, at: datetime) -> str:
    """A new snapshot under base; one that is there already stays and is an error."""
    path = f"{base.rstrip('/')}/{snapshot_name(at)}/certificate_database"
    df.write.mode("errorifexists").parquet(path)
    return path


def _in_order(df: DataFrame) -> DataFrame:
    """As a report is read: changed rows by id, others as their source has them. Only files that go out are sorted."""
    from ..operators.diff import CHANGED, find_id_column

    if CHANGED in df.columns:
        return df.sort(F.col(f"`{find_id_column(df.columns)}`"))
    return df.sort("ord") if "ord" in df.columns else df


def append_report(df: DataFrame, snapshot: str, name: str) -> str:
    """A report beside its snapshot, in its order; of reports of one name each gets a place of its own, as new sheets do."""
    spark, base = df.sparkSession, f"{snapshot.rstrip('/').rpartition('/')[0]}/report={name}"
    n, path = 0, base
    while exists(spark, path):
        n += 1
        path = f"{base}{n}"
    _in_order(df).write.mode("errorifexists").parquet(path)
    return path


def _reads(df: DataFrame, path: str) -> bool:
    """Whether df reads anything under path."""
    fs, p = _fs(df.sparkSession, path)
    own = str(fs.makeQualified(p).toUri().getPath()).rstrip("/")
    plain = lambda f: str(df.sparkSession._jvm.org.apache.hadoop.fs.Path(f).toUri().getPath())
    return any(plain(f) == own or plain(f).startswith(f"{own}/") for f in df.inputFiles())


def write_report(df: DataFrame, path: str) -> None:
    """A report at a path of the caller's, in its order, in place of what is there; ValueError where it is made from that."""
    if _reads(df, path):
        raise ValueError(f"{path} is read by the report that would replace it")
    _in_order(df).write.mode("overwrite").parquet(path)


def write_filtered(source: str, target: str, spark: SparkSession, **options) -> None:
    """The changed report at source without rows of one change only, at target; see diff.without_change for the options."""
    from ..operators.diff import without_change

    write_report(without_change(spark.read.parquet(source), **options), target)


def write_standardised(source: str, target: str, assets: DataFrame) -> None:
    """The sheet at source with companies and cities as assets have them, at target."""
    from ..operators.resolve import standardise

    write_report(standardise(load_sheet(assets.sparkSession, source), assets), target)


def load_state(spark: SparkSession, path: str) -> dict:
    """The last run's state, the whole one of the highest number; none is a first run."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return {}
    for _, p in sorted(((int(n), f) for f in fs.listStatus(folder) if (n := f.getPath().getName().removesuffix(".json")).isdigit()), key=lambda x: -x[0]):
        text = "\n".join(r[0] for r in spark.read.text(p.getPath().toString()).collect())  # one small object
        try:
            return json.loads(text)
        except ValueError:
            continue  # cut short by a crash: the one before it holds
    return {}


def save_state(spark: SparkSession, path: str, previous: str, **more) -> None:
    """A new numbered state in the folder path, after the snapshot is complete; older ones stay until it is whole, the last two for good."""
    fs, folder = _fs(spark, path)
    fs.mkdirs(folder)
    numbers = sorted(int(n) for f in fs.listStatus(folder) if (n := f.getPath().getName().removesuffix(".json")).isdigit())
    at = spark._jvm.org.apache.hadoop.fs.Path
    name = at(folder, f"{numbers[-1] + 1 if numbers else 0}.json")
    out = fs.create(name, False)
    out.write(bytearray(json.dumps({"prev_file_name": previous} | more).encode()))
    out.close()
    for n in numbers[:-1]:
        fs.delete(at(folder, f"{n}.json"), False)
