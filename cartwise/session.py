"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change plans, not results. The defaults of the cluster stand for the rest
# (executor sizes, shuffle partitions, the checkpoint folder).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # U, UC, US and UCS tables are all clustered by user_id; this lets joins on
    # (user_id, cate) or (user_id, shop_id) use that clustering without another shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # An assembled data set has about 280 columns; the default of 100 would turn
    # whole-stage code generation off for it.
    "spark.sql.codegen.maxFields": "400",
    # The JVM leaves longer methods to its interpreter; such a stage runs as separate operators, which it compiles.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Features of a family travel as one struct through the joins of a set; taken apart below them, if a single one is not
    # used, all rows would be wide again.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "false",
    # Rows of a shuffle are narrow and packed, what a task makes of them in memory is some 30 times as large;
    # the default of 64 MB gives tasks of 2 GB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def set_plan_conf(spark: SparkSession) -> None:
    """Give a session that someone else has built the settings the plans rely on."""
    for key, value in PLAN_CONF.items():
        spark.conf.set(key, value)


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**PLAN_CONF, "spark.sql.session.timeZone": "UTC", **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named by the cluster in spark.checkpoint.dir.

    A temporary folder is used only in local mode, where driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="cartwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/cartwise/{uuid.uuid4().hex[:12]}/{name}"
