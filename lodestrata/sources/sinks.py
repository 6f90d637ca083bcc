"""Sinks: JSON, CSV, resolved tracks, link cache, backlog, reports, playlist payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .arrays import write_array

# Columns of the release CSV.
CSV_COLUMNS = (
    "artist", "track_or_project_title", "release_type", "confidence_score", "extraction_method", "source_article_title", "source_article_url", "source_name", "article_date", "embedded_music_links",
    "release_article",
)
BAR = " | "
# Fields of a resolved track.
RESOLVED_COLUMNS = (
    "rank", "ranking_score", "artist", "track_or_project_title", "source_names", "spotify_url", "spotify_uri", "spotify_id", "soundcloud_url", "soundcloud_track_id", "notes", "source_record",
)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one folder; distributed."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str, order: list[str], drop: tuple[str, ...] = ()) -> None:
    """One pretty JSON array, in files that follow one another by name (:mod:`.arrays`)."""
    write_array(df, path, order, drop)


def resolved_rows(tracks: DataFrame, source_record: Column) -> DataFrame:
    """Resolved tracks in the shape in which they are written: links, notes, and the record they come from."""
    named = tracks.withColumnRenamed("title", "track_or_project_title").withColumn("source_record", source_record)
    address = F.when(F.coalesce("spotify_id", F.lit("")) != "", F.concat(F.lit("https://open.spotify.com/track/"), "spotify_id"))
    if "spotify_url" not in tracks.columns:
        named = named.withColumn("spotify_url", address)
    return named.select(*RESOLVED_COLUMNS)


def write_resolved(tracks: DataFrame, source_record: Column, path: str) -> None:
    write_array(resolved_rows(tracks, source_record), path, ["rank"])


def csv_rows(df: DataFrame) -> DataFrame:
    """Fixed columns, links joined by bars; the bag is dropped."""
    held = df.withColumn("embedded_music_links", F.array_join("embedded_music_links", BAR))
    return held.select(*[F.col(c).cast("string").alias(c) if c != "confidence_score" else F.round(c, 3).cast("string").alias(c) for c in CSV_COLUMNS])


def write_csv(df: DataFrame, path: str) -> None:
    csv_rows(df).write.mode("overwrite").option("escape", '"').csv(path, header=True)


def artist_csv_rows(df: DataFrame) -> DataFrame:
    """Array columns joined by bars, numbers as text, null as empty."""
    out = []
    for f in df.schema.fields:
        c = F.array_join(f.name, BAR) if f.dataType.typeName() == "array" else F.col(f.name).cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(f.name))
    return df.select(*out)


def write_artist_csv(df: DataFrame, path: str) -> None:
    artist_csv_rows(df).write.mode("overwrite").option("escape", '"').csv(path, header=True)


def read_cache(spark, path: str, schema: str) -> DataFrame:
    """The link cache; a missing one is empty, and so is one with a line that is no JSON."""
    try:
        rows = spark.read.schema(f"{schema}, _corrupt_record string").json(path)
        if not rows.where("_corrupt_record is not null").limit(1).collect():
            return rows.drop("_corrupt_record")
    except Exception as e:  # noqa: BLE001  Spark raises AnalysisException for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], schema)


def merged_cache(old: DataFrame, new: DataFrame, key: str = "cache_key") -> DataFrame:
    """Old entries whose key is not renewed, and the new ones."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def write_cache(cache: DataFrame, path: str, staging: str) -> None:
    """Written beside and read back, then moved over: the old cache may be one of the inputs."""
    cache.write.mode("overwrite").json(staging)
    cache.sparkSession.read.schema(cache.schema).json(staging).write.mode("overwrite").json(path)


def push_report(tracks: DataFrame, uri: str = "spotify_uri", upload: str = "soundcloud_track_id") -> DataFrame:
    """One row: how many tracks could be sent to each platform, without sending them."""
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return tracks.agg(F.count(F.lit(1)).alias("tracks"), F.count_if(some(uri)).alias("spotify_tracks"), F.count_if(some(upload)).alias("soundcloud_tracks"))


def playlist_payload(tracks: DataFrame, id_col: str, pos: str, batch: int = 100, numeric: bool = False) -> DataFrame:
    """(batch, pos, id): distinct ids in order of their first place, in batches (:mod:`.delivery` sends them)."""
    rows = tracks.where(F.col(id_col).rlike(r"^\d+$") if numeric else F.coalesce(F.col(id_col), F.lit("")) != "")
    firsts = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(pos).alias("pos"))
    return numbered(firsts, ["pos", "id"], "_n").select(F.floor((F.col("_n") - 1) / batch).alias("batch"), "pos", "id")
