"""Reading, writing and reusing tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import cartwise
from cartwise.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class Tables:
    """The five input tables of a run, already cleaned."""

    actions: DataFrame
    users: DataFrame
    shops: DataFrame
    products: DataFrame
    comments: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; columns are found by name, whatever their order in the file.

    A declared column that the header lacks fails with its name; columns that are not declared are kept as
    text, after the declared ones. A malformed row, or a file whose header differs from the first, fails the job.
    """
    header = spark.read.csv(path, header=True).columns
    declared = {f.name: f for f in schema}
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    found = T.StructType([declared.get(c, T.StructField(c, T.StringType())) for c in header])
    rows = spark.read.csv(
        path, schema=found, header=True, mode="FAILFAST", dateFormat="yyyy-MM-dd", enforceSchema=False
    )
    return rows.select(*declared, *[c for c in header if c not in declared])


def raw_schema(name: str) -> T.StructType:
    """The declared schema with dates as text: raw files carry a time of day, which cleaning cuts off."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.dataType == T.DateType() else f.dataType, True)
        for f in SCHEMAS[name]
    ])


def read_tables(spark: SparkSession, folder: str, form: str = "csv") -> Tables:
    """The five raw tables from ``folder``: action, user, shop, product, comment; CSV or parquet."""
    def read(name: str) -> DataFrame:
        path = f"{folder}/{name}"
        if form != "csv":
            return spark.read.parquet(path)
        rows = read_csv(spark, path, raw_schema(name))
        # Undeclared columns tell equal actions apart; no other table uses them.
        return rows if name == "action" else rows.select(*SCHEMAS[name].names)

    return Tables(
        actions=read("action"), users=read("user"), shops=read("shop"), products=read("product"),
        comments=read("comment"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, dateFormat="yyyy-MM-dd")


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it lies in, as Spark resolves them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, path: str) -> bool:
    marker, store = hadoop_path(spark, f"{path}/_SUCCESS")
    return store.exists(marker)


@cache
def code_version() -> str:
    """A hash of the code that makes tables: this package without the training-data operators."""
    root = Path(cartwise.__file__).parent
    sources = [p for p in sorted(root.rglob("*.py")) if p.relative_to(root).parts[0] != "llm"]
    return hashlib.sha256(b"\0".join(p.read_bytes() for p in sources)).hexdigest()


def table_path(path: str, manifest: str | None = None) -> str:
    """Where a table made of ``manifest`` lies: a folder of ``path`` that its hash and the code's name, or ``path`` without one."""
    if manifest is None:
        return path
    return f"{path}/made-of-{hashlib.sha256(f'{code_version()} {manifest}'.encode()).hexdigest()[:24]}"


def has_table(spark: SparkSession, path: str, manifest: str | None = None) -> bool:
    """True if a finished table for the manifest lies at ``path``; the committer leaves _SUCCESS last."""
    return _finished(spark, table_path(path, manifest))


def state_of(df: DataFrame) -> str:
    """What ``df`` reads: its files with sizes and times, or the plan's hash if it reads none."""
    files = []
    for name in sorted(df.inputFiles()):
        path, store = hadoop_path(df.sparkSession, name)
        status = store.getFileStatus(path)
        files.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(files).encode()).hexdigest() if files else str(df.semanticHash())


def materialize(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], partition_by: str | None = None,
    manifest: str | None = None,
) -> DataFrame:
    """Read the table at ``path`` if a finished one is there, else compute and write it first.

    ``manifest`` says what the table is made of (inputs and parameters). Tables of different manifests, or made by
    different code, lie in different folders, and a folder counts only with the committer's marker: whenever a job is
    killed, no folder holds the rows of another manifest, and a table once made is there when its inputs come back. The
    written table cuts the lineage, so a lost executor costs only the running stage.
    """
    found = table_path(path, manifest)
    if _finished(spark, found):
        return spark.read.parquet(found)
    df = compute()
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(found)
    return spark.read.schema(df.schema).parquet(found)


def materialize_bucketed(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], by: str, buckets: int, manifest: str | None = None
) -> DataFrame:
    """As :func:`materialize`, in ``buckets`` buckets of the hash of ``by``: what follows groups and joins on it without a shuffle.

    ``compute`` gives rows that are clustered by ``by`` into as many partitions, so that a task writes one bucket. The
    table is named in the session's catalog, as Spark knows buckets from there only; the files lie in the folder, and another
    session names them again.
    """
    found = f"{table_path(path, manifest)}-{buckets}-by-{by}"
    name = f"cartwise_{hashlib.sha256(found.encode()).hexdigest()[:24]}"
    if not _finished(spark, found):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        compute().write.mode("overwrite").bucketBy(buckets, by).option("path", found).saveAsTable(name)
    elif not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(found).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{found}'")
    return spark.table(name)
