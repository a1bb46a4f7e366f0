"""Tables written between the jobs of one operator, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
BATCH_ROWS, BATCH_BYTES = 4000, 8 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``. Only a local session (tests) may do without, in a folder of its own."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="stereobate-")
    return _LOCAL["dir"]


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; this cuts the lineage."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stereobate_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that ``save`` wrote and no later plan reads."""
    path = getattr(df, "_stereobate_path", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; batches that Python gets hold at most BATCH_ROWS rows and BATCH_BYTES bytes, as texts may be long.

    The settings are the session's, since a plan reads them only when it runs; a smaller value of the user stays.
    """
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = int(str(conf.get(f"spark.sql.execution.arrow.{key}")).rstrip("b"))
        if now <= 0 or now > most:
            conf.set(f"spark.sql.execution.arrow.{key}", str(most))
    return df
