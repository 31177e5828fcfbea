"""Question records that keep arriving: a stream of JSON-lines folders into an append-only table and running counts.

The batch operators need no stream; these two let the same records be taken in as they are written, with Spark's own
checkpoints for exactly-once files, and a watermark that bounds the state kept for redeliveries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from roomweave.functions.normalize import record_key
from roomweave.sources import schemas

SCHEMA = f"{schemas.QUESTION}, pattern_name STRING, ingested_at TIMESTAMP"


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Questions of all files that are written to the folder, from the first on."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


def first_deliveries(questions: DataFrame, late: str = "7 days") -> DataFrame:
    """Each record once; redeliveries within `late` of the first are dropped, and state older than that is forgotten.

    Rows without scene or pose index have no record name and all stay.
    """
    name = F.coalesce(record_key(F.col("scene_id"), F.col("pattern_name"), F.col("camera_pose_idx"), F.col("question_id")), F.uuid())
    return questions.withColumn("record", name).withWatermark("ingested_at", late).dropDuplicatesWithinWatermark(["record"])


def daily_counts(questions: DataFrame, late: str = "7 days") -> DataFrame:
    """Questions per day of arrival and type; a day is final once the watermark has passed it."""
    day = F.window("ingested_at", "1 day")
    return questions.withWatermark("ingested_at", late).groupBy(day, "question_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("day"), "question_type", "n")


def append(rows: DataFrame, out: str, state: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True)
