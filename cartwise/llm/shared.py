"""What several operators of this folder need: written tables, checked broadcasts, ASCII lower case."""

from __future__ import annotations

import string
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cartwise
from cartwise.session import new_folder

#: Rows up to which a narrow table (a few numbers a row) is sent to every executor.
BROADCAST_ROWS = 200_000

#: The white space of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(cartwise.__file__).parent
        folder = Path(SparkFiles.getRootDirectory()) / "packages"
        folder.mkdir(exist_ok=True)
        with zipfile.ZipFile(folder / "cartwise.zip", "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, Path("cartwise") / p.relative_to(root))
        sc.addPyFile(str(folder / "cartwise.zip"))
        _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs no more than the running stage."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written narrow table, marked for broadcast only if its counted rows are within the bound."""
    return F.broadcast(table) if table.count() <= rows else table


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; the slower ``translate`` only where a text has other than ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` but for ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def carried(df: DataFrame, *replaced: str) -> Column:
    """The columns of ``df`` but for those replaced, as one struct ``row``, so that no helper column can clash with them."""
    return F.struct(*(quoted(c) for c in without(df, *replaced))).alias("row")


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
