"""Writing scenes, tracks and goals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The splits that carry goals.
GOAL_SPLITS = ("train", "val", "test_private")


def balanced(rows: DataFrame, *keys: str) -> DataFrame:
    """Bring the rows of a folder together before it is written, in pieces of the usual size:
    few files each, and no task with all rows of a large one."""
    return rows.hint("rebalance", *keys)


def track_json(tracks: DataFrame) -> Column:
    fields = [F.col("frame").alias("f"), F.col("pedestrian").alias("p"), "x", "y"]
    if "prediction_number" in tracks.columns:
        fields.append("prediction_number")
    return F.to_json(F.struct(F.struct(*fields).alias("track")))


def scene_json() -> Column:
    """A scene line. An untyped scene has the tag 0, a typed one a pair of type and kinds;
    the pair is the only mixed-type value, so it is put together as text."""
    head = F.to_json(F.struct(F.col("scene").alias("id"), F.col("pedestrian").alias("p"), F.col("start").alias("s"),
                              F.col("end").alias("e"), "fps"))
    pair = F.concat(F.lit("["), F.col("tag").cast("string"), F.lit(", ["), F.array_join(F.col("sub_tags").cast("array<string>"), ", "), F.lit("]]"))
    tag = F.when(F.col("sub_tags").isNull(), F.col("tag").cast("string")).otherwise(pair)
    return F.concat(F.lit('{"scene": '), F.regexp_replace(head, r"\}$", ""), F.lit(', "tag": '), tag, F.lit("}}"))


def ndjson_lines(scenes: DataFrame, tracks: DataFrame) -> DataFrame:
    """Scene lines and track lines as (dataset, split, value)."""
    return (scenes.select("dataset", "split", scene_json().alias("value"))
            .unionByName(tracks.select("dataset", "split", track_json(tracks).alias("value"))))


def write_ndjson(scenes: DataFrame, tracks: DataFrame, folder: str) -> None:
    """One folder per dataset and split, replaced if it exists."""
    balanced(ndjson_lines(scenes, tracks), "dataset", "split").write.mode("overwrite").partitionBy("dataset", "split").text(folder)


def tracks_only(tracks: DataFrame) -> DataFrame:
    """Track lines in order of pedestrian and frame."""
    return tracks.orderBy("dataset", "pedestrian", "frame", "x", "y").select("dataset", track_json(tracks).alias("value"))


def write_tracks_only(tracks: DataFrame, folder: str) -> None:
    tracks_only(tracks).write.mode("overwrite").partitionBy("dataset").text(folder)


def csv_rows(tracks: DataFrame) -> DataFrame:
    return tracks.select("dataset", "frame", "pedestrian", "x", "y")


def write_csv(tracks: DataFrame, folder: str) -> None:
    """Lines ``frame,pedestrian,x,y`` per dataset."""
    balanced(csv_rows(tracks), "dataset").write.mode("overwrite").partitionBy("dataset").csv(folder)


def goals_by_split(goals: DataFrame) -> DataFrame:
    """The same goals for every split that needs them."""
    return goals.withColumn("split", F.explode(F.lit(list(GOAL_SPLITS))))


def write_goals(goals: DataFrame, folder: str) -> None:
    balanced(goals_by_split(goals), "split").write.mode("overwrite").partitionBy("split").parquet(folder)


def write_tables(rows: DataFrame, folder: str) -> None:
    """Our own form: Parquet by dataset and split, which later reads can prune by."""
    balanced(rows, "dataset", "split").write.mode("overwrite").partitionBy("dataset", "split").parquet(folder)


# The buckets of a stored track table, and the order of its rows inside one.
PERSON, IN_ORDER = ("dataset", "split", "pedestrian"), ("dataset", "split", "pedestrian", "frame", "x", "y")


def write_buckets(tracks: DataFrame, table: str, folder: str, buckets: int = 200) -> None:
    """Split tracks as a table in ``buckets`` by pedestrian, each one file in order of frames. What works by pedestrian (windows,
    paths of stored scenes) needs no shuffle of such a table; read it with ``spark.table``. Choose the number for buckets of a
    few hundred megabytes, and at least ``spark.sql.shuffle.partitions`` of the jobs that read it: Spark shuffles fewer buckets
    anew. A pedestrian is never divided."""
    (tracks.repartition(buckets, *PERSON).write.mode("overwrite").option("path", folder)
     .bucketBy(buckets, *PERSON).sortBy(*IN_ORDER).saveAsTable(table, format="parquet"))
