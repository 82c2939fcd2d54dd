"""Session defaults and tables kept in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators are tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all machines of the cluster share.  Where it is
    unset, a session on one machine gets a folder of its own, removed when Python ends; on a cluster
    there is no such folder to choose, so it is an error."""
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if folder:
        return folder
    master = conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all machines of the cluster share")
    own = tempfile.mkdtemp(prefix="reportloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    return f"file://{own}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives the loss of
    executors, and lets several passes share one computation.  Removed when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/reportloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
