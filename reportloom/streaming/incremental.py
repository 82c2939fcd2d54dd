"""History kept up to date from arriving files, each run reading only what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.operators.history import write_weeks
from reportloom.operators.profile import count_states


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def follow(spark: SparkSession, source: str, schema, target: str, checkpoint: str) -> None:
    """Upserts new history files into ``target``, a table partitioned by year and week, and ends when
    all have been read.  Only the weeks that a batch touches are rewritten; re-running a week, or
    a batch after a failure, leaves one row per project and week."""
    arriving = spark.readStream.schema(schema).parquet(source)

    def upsert(batch: DataFrame, number: int) -> None:
        rows = batch.where("project_id is not null and year is not null and week is not null")
        old = spark.read.schema(rows.schema).parquet(target) if _exists(spark, target) else rows.limit(0)
        touched = rows.select("year", "week").distinct()
        both = rows.unionByName(old.join(touched, ["year", "week"], "left_semi"))
        newest = both.groupBy("project_id", "year", "week").agg(F.max_by(F.struct(*rows.columns), F.struct("recorded_at", "rec_id")).alias("r")).select("r.*")
        # the rows read are replaced, so they are written aside before
        aside = f"{checkpoint}/aside/{number}"
        newest.write.mode("overwrite").parquet(aside)
        write_weeks(spark.read.schema(rows.schema).parquet(aside), target)

    query = arriving.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def follow_profile(spark: SparkSession, source: str, schema, target: str, checkpoint: str) -> None:
    """Appends the histograms of new files to ``target``; merge_states adds them up when read."""
    arriving = spark.readStream.schema(schema).parquet(source)

    def append(batch: DataFrame, number: int) -> None:
        count_states(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    query = arriving.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def vanished(arriving: DataFrame, lateness: str = "28 days") -> DataFrame:
    """Streaming counts of rows and of missing figures per project and four weeks of recording; rows
    later than ``lateness`` are left out."""
    return (
        arriving.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
        .withWatermark("recorded_at", lateness)
        .groupBy(F.window("recorded_at", "28 days"), "project_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("plan").isNull() | F.isnan("plan")).alias("n_plan_missing"), F.count_if(F.col("actual").isNull() | F.isnan("actual")).alias("n_actual_missing"))
    )
