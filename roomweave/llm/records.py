"""Question rows with the name of their record, shared by the operators on questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomweave.functions.normalize import record_key, scene_key


def named(questions: DataFrame) -> DataFrame:
    """(…, scene, record): the clean scene id and the record's name; record is null without scene or pose index."""
    return questions.withColumn("scene", scene_key(F.col("scene_id"))).withColumn("record", record_key(F.col("scene_id"), F.col("pattern_name"), F.col("camera_pose_idx"), F.col("question_id")))
