"""Scene folders and question files as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomweave.sources import schemas

FOLDER = "([^/]+)/[^/]+$"


def _texts(spark: SparkSession, root: str, name: str, scenes: list[str] | None) -> DataFrame:
    """(scene_id, value): whole files of one name, one a scene folder."""
    d = spark.read.text(f"{root.rstrip('/')}/*/{name}", wholetext=True).select(F.url_decode(F.regexp_extract("_metadata.file_path", FOLDER, 1)).alias("scene_id"), "value")
    return d.where(F.col("scene_id").isin(*scenes)) if scenes else d


def _exists(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def labels(spark: SparkSession, root: str, scenes: list[str] | None = None) -> DataFrame:
    """(scene_id, label_ord, ins_id, id, label, bounding_box) of all scenes with a labels.json; none at all is an error."""
    if not _exists(spark, f"{root.rstrip('/')}/*/labels.json"):
        raise FileNotFoundError(f"no labels.json below {root}")
    parsed = _texts(spark, root, "labels.json", scenes).select("scene_id", F.posexplode(F.from_json("value", f"ARRAY<{schemas.LABEL}>")).alias("label_ord", "l"))
    return parsed.select("scene_id", "label_ord", "l.*")


def scenes(spark: SparkSession, root: str, chosen: list[str] | None = None) -> DataFrame:
    """Scene folders with labels, in order; a given list wins."""
    if chosen:
        return spark.createDataFrame([(s,) for s in chosen], "scene_id string")
    return _texts(spark, root, "labels.json", None).select("scene_id").orderBy("scene_id")


def structures(spark: SparkSession, root: str, chosen: list[str] | None = None, form: str = "any") -> DataFrame:
    """(scene_id, rooms, walls, occupancy); missing or damaged files leave nulls.

    A top-level list of rooms is taken with form `any`; such scenes have no walls.
    """
    empty = spark.createDataFrame([], f"scene_id STRING, {schemas.STRUCTURE}")
    both = empty
    if _exists(spark, f"{root.rstrip('/')}/*/structure.json"):
        t = _texts(spark, root, "structure.json", chosen).withColumn("s", F.from_json("value", f"STRUCT<{schemas.STRUCTURE.replace('rooms ', 'rooms: ').replace('walls ', 'walls: ')}>"))
        whole = F.from_json("value", f"ARRAY<{schemas.ROOM}>") if form == "any" else F.lit(None).cast(f"ARRAY<{schemas.ROOM}>")
        listed = F.ltrim("value").startswith("[")
        both = t.select("scene_id", F.when(listed, whole).otherwise(F.col("s.rooms")).alias("rooms"), F.when(~listed, F.col("s.walls")).alias("walls"))
    occupied = spark.createDataFrame([], f"scene_id STRING, occupancy STRUCT<{schemas.OCCUPANCY.replace(' ARRAY', ': ARRAY')}>")
    if _exists(spark, f"{root.rstrip('/')}/*/occupancy.json"):
        occupied = _texts(spark, root, "occupancy.json", chosen).select("scene_id", F.from_json("value", f"STRUCT<{schemas.OCCUPANCY.replace(' ARRAY', ': ARRAY')}>").alias("occupancy"))
    return both.join(occupied, "scene_id", "full_outer")


def questions(spark: SparkSession, root: str) -> DataFrame:
    """Questions of {root}/{pattern}/{scene}/questions.jsonl with the folders' names; blank lines are no questions."""
    where = F.regexp_extract("_metadata.file_path", "([^/]+)/([^/]+)/[^/]*questions\\.jsonl$", 1)
    scene = F.regexp_extract("_metadata.file_path", "([^/]+)/([^/]+)/[^/]*questions\\.jsonl$", 2)
    d = spark.read.schema(schemas.QUESTION).json(f"{root.rstrip('/')}/*/*/*questions.jsonl")
    return d.withColumn("pattern_name", where).withColumn("scene_id", F.coalesce("scene_id", scene))


def json_lines(spark: SparkSession, path: str, schema: str = schemas.QUESTION) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def metadata(spark: SparkSession, root: str) -> DataFrame:
    return json_document(spark, f"{root.rstrip('/')}/*/*/metadata.json", schemas.METADATA).withColumnRenamed("pattern", "pattern_name")


def image_paths(spark: SparkSession, root: str) -> DataFrame:
    """Paths of images below the root; the files themselves are not read."""
    if not _exists(spark, f"{root.rstrip('/')}/*/*/images/*.png"):
        return spark.createDataFrame([], "image_path STRING")
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*/images/*.png").select("path")
    return files.select(F.regexp_extract("path", "([^/]+/[^/]+/images/[^/]+)$", 1).alias("image_path"))
