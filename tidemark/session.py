"""Session defaults the library relies on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Applied to sessions we build; a cluster session keeps its own sizing.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", *, app: str = "tidemark", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint directory, else the session's warehouse.

    Outside local mode the latter has to be on a file system of its own, as a path of
    the driver's machine is none the executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = (configured or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    alone = spark.sparkContext.master.split("[")[0] == "local"
    if not configured and not alone and ("://" not in folder and folder.startswith(("/", "file:")) or folder.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side control rows as a local relation, without starting Python workers.

    Dates, instants and decimals are given as text and cast.
    """
    columns = zip(*rows) if rows else [() for _ in schema.fields]
    arrays = [
        pa.array(list(values), _ARROW.get(f.dataType.simpleString(), pa.string()))
        for f, values in zip(schema.fields, columns)
    ]
    table = pa.table(arrays, names=schema.fieldNames())
    return spark.createDataFrame(table).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
