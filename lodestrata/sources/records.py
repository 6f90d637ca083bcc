"""Release JSON arrays, artist CSV files and small configuration texts."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import parse_int
from ..functions.text import clean, clean_optional
from ..functions.urls import catalogue_artist_id
from ..operators.components import checkpointed
from ..schema import RANKED_RELEASE
from .arrays import array_elements


def input_files(spark: SparkSession, folders: list[str], files: list[str], defaults: list[str]) -> list[str]:
    """Sorted JSON files of the folders, then the named files, else the defaults.

    Listed through the file system that Spark itself uses; missing paths are skipped.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: list[str] = []
    for folder in folders:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            out += sorted(str(s.getPath()) for s in fs.listStatus(p) if str(s.getPath()).endswith(".json"))
    named = files or ([] if folders else defaults)
    for f in named:
        p = jvm.org.apache.hadoop.fs.Path(f)
        if p.getFileSystem(conf).exists(p):
            out.append(str(p))
    return out


def _plain_path(c: Column) -> Column:
    """A file's address as Hadoop writes it: decoded, one slash after the scheme."""
    return F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _numbered(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(_path, file_no) of the named files: a configuration table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    full = []
    for p in paths:
        q = jvm.org.apache.hadoop.fs.Path(p)
        full.append(re.sub("^([A-Za-z][A-Za-z0-9+.-]*):/+", r"\1:/", q.getFileSystem(conf).makeQualified(q).toString()))
    return spark.createDataFrame(list({p: (p, n) for n, p in reversed(list(enumerate(full)))}.values()), "_path string, file_no int")


def _array_items(spark: SparkSession, files: DataFrame, mode: str) -> DataFrame:
    """One row (source_file, file_no, pos, v) per object of each body's top-level array."""
    parsed = F.parse_json("body") if mode == "FAILFAST" else F.try_parse_json("body")
    view = f"_lodestrata_{uuid.uuid4().hex}"
    files.select("source_file", "file_no", parsed.alias("j")).where("j is not null and schema_of_variant(j) like 'ARRAY%'").createOrReplaceTempView(view)
    out = spark.sql(f"select source_file, file_no, e.pos, e.value as v from {view}, lateral variant_explode(j) as e where schema_of_variant(e.value) like 'OBJECT%'")
    spark.catalog.dropTempView(view)
    return out


def release_arrays(spark: SparkSession, paths: list[str], mode: str = "DROP") -> DataFrame:
    """Releases of JSON array files, with ``source_file`` and ``load_ordinal``.

    Files are read by byte ranges (:mod:`.arrays`), so one file may be of any size.
    Files that are no array and elements that are no object are skipped, and so
    are rows marked as no release. Malformed files are skipped (``DROP``) or
    raise (``FAILFAST``, which reads files that are no array whole, to see whether they
    are JSON). Ordinals follow the order of the paths, then of the array.
    """
    if not paths:
        return spark.createDataFrame([], RANKED_RELEASE).withColumns({"source_file": F.lit(None).cast("string"), "load_ordinal": F.lit(None).cast("long")})
    elements, files = array_elements(spark, list(dict.fromkeys(paths)))
    parsed = elements.withColumn("v", F.try_parse_json("body"))
    broken = parsed.where("v is null").select("path").distinct().withColumn("_broken", F.lit(True))
    sound = checkpointed(files.join(broken, "path", "left").select("path", "array", (F.col("sound") & F.col("_broken").isNull()).alias("sound")))  # a row for each file
    if mode == "FAILFAST":
        bad = sound.where("array and not sound").select("path")
        if others := [unquote(r["path"]) for r in sound.where("not array").collect()]:
            whole = spark.read.text(others, wholetext=True)
            bad = bad.unionByName(whole.where(F.try_parse_json("value").isNull()).select(F.col("_metadata.file_path").alias("path")))
        if found := [r["path"] for r in bad.limit(3).collect()]:
            raise ValueError(f"malformed JSON: {', '.join(found)}")
    held = parsed.join(F.broadcast(sound.where("array and sound").select("path")), "path").where("schema_of_variant(v) like 'OBJECT%'")
    placed = held.withColumn("_path", _plain_path(F.col("path"))).join(F.broadcast(_numbered(spark, paths)), "_path")
    return _released(placed.select(F.col("path").alias("source_file"), "file_no", "pos", "v"))


def releases_of(spark: SparkSession, files: DataFrame, mode: str = "DROP") -> DataFrame:
    """Releases of the JSON arrays in (body, source_file, file_no), as :func:`release_arrays`."""
    return _released(_array_items(spark, files, mode))


def _released(items: DataFrame) -> DataFrame:
    """Release rows of array elements (source_file, file_no, pos, v)."""
    got = [F.expr(f"try_variant_get(v, '$.{f.name}', '{f.dataType.simpleString()}')").alias(f.name) for f in RANKED_RELEASE.fields if f.name != "ranking_factors"]
    factors = F.expr("cast(to_json(try_variant_get(v, '$.ranking_factors', 'variant')) as string)").alias("ranking_factors")
    ordinal = (F.col("file_no").cast("long") * F.lit(1 << 40) + F.col("pos")).alias("load_ordinal")
    rows = items.select(*got, factors, "source_file", ordinal)
    return rows.where(F.coalesce(F.col("release_article"), F.lit(True)))


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, escape='"')


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``ordinal`` in file order (ids rise within and across a file's partitions)."""
    return rows.withColumn("ordinal", F.monotonically_increasing_id())


def artist_profiles(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """Artist profiles with any identifier; a catalogue URL has to be readable. First ``limit`` kept rows."""
    rows = profiles_of(ordered(_csv(spark, path)))
    return rows.orderBy("ordinal").limit(limit) if limit else rows


def profiles_of(rows: DataFrame) -> DataFrame:
    """Rows of an artist file with any identifier that can be read; missing columns are empty."""
    for c in ("artist_name", "spotify_url", "soundcloud_url", "soundcloud_user_id", "genre", "rank", "monthly_listeners"):
        rows = rows.withColumn(c, clean_optional(F.col(c)) if c in rows.columns else F.lit(""))
    some = (F.col("spotify_url") != "") | (F.col("soundcloud_url") != "") | (F.col("soundcloud_user_id") != "")
    readable = (F.col("spotify_url") == "") | (catalogue_artist_id(F.col("spotify_url")) != "")
    return rows.where(some & readable)


def barred(c: Column) -> Column:
    """Trimmed, filled entries of a list joined by bars."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def followed_artists(spark: SparkSession, path: str) -> DataFrame:
    return followed_of(ordered(_csv(spark, path)))


def followed_of(rows: DataFrame) -> DataFrame:
    """Rows of a followed-artist file, typed."""
    text = [clean(F.col(c)).alias(c) for c in ("artist_name", "soundcloud_url", "soundcloud_user_id", "country", "city")]
    lists = [barred(F.col(c)).alias(c) for c in ("genres", "edm_match_terms")]
    numbers = [parse_int(F.col(c)).alias(c) for c in ("followers_count", "track_count")]
    return rows.select(*text, *lists, *numbers, "ordinal")


def config_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a list that are neither blank nor comments, with ``ordinal``."""
    return lines_of(ordered(spark.read.text(path)))


def lines_of(rows: DataFrame) -> DataFrame:
    lines = rows.select(F.trim("value").alias("value"), "ordinal")
    return lines.where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def genre_targets(spark: SparkSession, path: str) -> DataFrame:
    """url, limit, genre of ``url,limit[,genre]`` lines; fewer fields raise."""
    return targets_of(config_lines(spark, path))


def targets_of(lines: DataFrame) -> DataFrame:
    p = F.transform(F.split("value", ","), lambda x: F.trim(x))
    checked = F.when(F.size(p) < 2, F.raise_error(F.concat(F.lit("expected url,limit: "), F.col("value")))).otherwise(p)
    rows = lines.select(checked.alias("p"), "ordinal")
    return rows.select(F.element_at("p", 1).alias("url"), F.element_at("p", 2).cast("int").alias("limit"), F.nullif(F.try_element_at("p", F.lit(3)), F.lit("")).alias("genre"), "ordinal")


def first_per_target(rows: DataFrame, target: str, limit: str, order: str) -> DataFrame:
    """At most ``limit`` rows of each target, in order (Spark limits each group before the shuffle where the bound is fixed)."""
    w = Window.partitionBy(target).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= F.col(limit)).drop("_n")


def paged_items(pages: DataFrame, max_items: int | None = None) -> DataFrame:
    """Items of recorded collection pages (cursor, page, items variant) in order, at most ``max_items`` of each cursor."""
    items = pages.select("cursor", "page", F.posexplode(F.try_variant_get("items", "$", "array<variant>")).alias("pos", "item"))
    if max_items is None:
        return items
    w = Window.partitionBy("cursor").orderBy("page", "pos")
    return items.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max_items).drop("_n")
