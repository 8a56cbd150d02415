"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: What an Arrow batch holds at most (or one row), unless the session asks for less.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, a temporary one on a local master (tests) only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='weft-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/weft-{name}-{uuid.uuid4().hex}"


def nullable(schema: StructType) -> StructType:
    out = StructType()
    for f in schema.fields:
        out.add(f.name, f.dataType, True, f.metadata)
    return out


def stored(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again; ``options`` are the writer's (__ for dots).

    It cuts lineage: a lost executor costs tasks, never an earlier stage. The table has its own
    plain scan, so a later join gets exchanges that AQE can split when a key is hot.
    """
    path = fresh_path(spark, name)
    df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lets Python workers get their rows in batches of bounded bytes, however long the texts are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").lower()
    units = {"b": 0, "k": 10, "m": 20, "g": 30}
    unit = next((u for u in units if u in now), "b")
    digits = "".join(c for c in now if c.isdigit())
    if not digits or int(digits) << units[unit] > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a few large files are dealt out, an input of many partitions stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
