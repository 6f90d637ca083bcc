"""Order-dependent selection of a playlist from a ranked pool of any size."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.text import associated_artist_keys, base_version_title, primary_artist_key
from .components import HUBS, checkpointed, join_keyed
from .filters import extended_version, has_platform_link, isrc_outside_window, unwanted_variant
from .ordering import numbered
from .score import bag

#: Usual size of the pool of a playlist.
POOL = 150
#: Pools of at most so many rows are walked in order by one task; larger ones are decided in rounds.
WALK = 4096
#: Before the rounds, so many times that number of the first undecided rows are walked at once.
HEADS = 16


def preferred_versions(tracks: DataFrame, key: Column, preference: list[Column], pos: str = "rank") -> DataFrame:
    """``tracks`` with ``preferred``: the best of each version key (first of equals); a null or empty key is its own group."""
    keyed = tracks.withColumn("_vk", F.nullif(key, F.lit("")))
    order = F.struct(*[(-p.cast("double")).alias(f"p{n}") for n, p in enumerate(preference)], F.col(pos).alias("pos"))
    best = keyed.where("_vk is not null").groupBy("_vk").agg(F.min(order).alias("_o")).select("_vk", F.col("_o.pos").alias("_best"))
    return keyed.join(best, "_vk", "left").withColumn("preferred", F.col("_vk").isNull() | (F.col(pos) == F.col("_best"))).drop("_vk", "_best")


def _walked(pool: DataFrame, max_primary: int, max_associated: int, pos: str) -> DataFrame:
    """:func:`greedy_caps` of a bounded pool, in order, in one task."""

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(pos, kind="stable").reset_index(drop=True)
        primary, associated, notes = Counter(), Counter(), []
        for note, artist, keys in zip(rows["note"], rows["artist_key"], rows["associated_keys"], strict=True):
            keys = [] if keys is None else [k for k in dict.fromkeys(keys) if k is not None]
            if isinstance(note, str):
                notes.append(note)
                continue
            if artist and primary[artist] >= max_primary:
                notes.append(f"skipped_artist_cap_{max_primary}")
                continue
            full = next((k for k in keys if associated[k] >= max_associated), None)
            if full is not None:
                notes.append(f"skipped_associated_artist_cap_{max_associated}:{full}")
                continue
            primary[artist] += bool(artist)
            associated.update(keys)
            notes.append(None)
        return rows.assign(note=pd.Series(notes, dtype=object))

    return pool.groupBy().applyInPandas(walk, pool.schema)


def _artist() -> Column:
    """A row's artist, empty if it has none."""
    return F.coalesce("artist_key", F.lit(""))


def _keys() -> Column:
    """A row's associated keys, each once."""
    return F.array_compact(F.array_distinct(F.coalesce("associated_keys", F.expr("cast(array() as array<string>)"))))


def _claims(open_rows: DataFrame, max_primary: int, max_associated: int, pos: str) -> DataFrame:
    """(pos, name, cap, place): what each open row takes a place of: its artist (place 0), then its associated keys in order."""
    artist = F.when(_artist() != "", F.struct(F.concat(F.lit("a:"), "artist_key").alias("name"), F.lit(max_primary).alias("cap"), F.lit(0).alias("place")))
    others = F.transform(_keys(), lambda k, i: F.struct(F.concat(F.lit("k:"), k).alias("name"), F.lit(max_associated).alias("cap"), (i + 1).alias("place")))
    return open_rows.select(F.col(pos).alias("pos"), F.explode(F.concat(F.array_compact(F.array(artist)), others)).alias("c")).select("pos", "c.*")


def _filled_at(claims: DataFrame, most: int, name: str) -> DataFrame:
    """(name, ``name``): the place in the order at which the cap of each name is reached by these claims.

    Spark keeps the first ``most`` (the greater cap) rows of a name in each task before it shuffles them.
    """
    order = Window.partitionBy("name").orderBy("pos")
    firsts = claims.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
    return firsts.where(F.col("_n") == F.col("cap")).select("name", F.col("pos").alias(name))


def _finished(live: DataFrame) -> DataFrame:
    """The claims of the rows that a walk over ``live`` keeps: few enough for one task."""

    def walk(claims: pd.DataFrame) -> pd.DataFrame:
        counts, kept = Counter(), []
        for at, own in claims.sort_values("pos", kind="stable").groupby("pos", sort=True):
            if all(counts[n] < c for n, c in zip(own["name"], own["cap"], strict=True)):
                counts.update(own["name"])
                kept.append(at)
        return claims[claims["pos"].isin(kept)].assign(kept=True)

    return live.groupBy().applyInPandas(walk, live.schema)


def _named(names: DataFrame, kind: str) -> DataFrame:
    """``names`` of one kind (a: artists, k: associated keys), without its mark."""
    return names.where(F.startswith("name", F.lit(kind))).withColumn("name", F.substr("name", F.lit(3)))


def _walked_head(claims: DataFrame) -> DataFrame:
    """The claims of the rows that a walk keeps, where ``used`` kept rows before them have each name: few enough for one task."""

    def walk(c: pd.DataFrame) -> pd.DataFrame:
        c = c.sort_values("pos", kind="stable")
        codes, names = pd.factorize(c["name"])
        room = np.zeros(len(names), dtype=np.int64)
        room[codes] = c["cap"] - c["used"]
        starts = np.flatnonzero(np.r_[True, c["pos"].to_numpy()[1:] != c["pos"].to_numpy()[:-1]])
        room, kept = room.tolist(), []
        for own in np.split(codes, starts[1:]):
            fits = all(room[n] > 0 for n in own)
            for n in own if fits else ():
                room[n] -= 1
            kept += [fits] * len(own)
        return c[np.array(kept, dtype=bool)]

    return claims.groupBy().applyInPandas(walk, claims.schema)


def _headed(rest: DataFrame, max_primary: int, max_associated: int, head: int) -> tuple[DataFrame, DataFrame]:
    """(claims of kept rows, rows that are left): the first ``head`` rows are walked, and rows after them with a name that is full are dropped.

    Done again while that leaves no more than half of the rows. Rows (pos, artist_key, associated_keys) hold a name, and caps are not 0.
    """
    n, kept = rest.count(), None
    while n:
        first = rest
        if n > head:
            upto = rest.agg(F.percentile_approx("pos", head / n, max(10_000, 16 * n // head))).first()[0]  # within a 16th of ``head`` rows
            first, rest = rest.where(F.col("pos") <= upto), rest.where(F.col("pos") > upto)
        claims = _claims(first, max_primary, max_associated, "pos")
        if kept is None:
            claims = claims.withColumn("used", F.lit(0).cast("long"))
        else:
            claims = claims.join(kept.groupBy("name").agg(F.count(F.lit(1)).alias("_used")), "name", "left").select("pos", "name", "cap", "place", F.coalesce("_used", F.lit(0)).alias("used"))
        new = checkpointed(_walked_head(claims))
        kept = new if kept is None else kept.unionByName(new)
        if n <= head:
            return kept, rest.limit(0)
        full = new.groupBy("name", "cap", "used").count().where("used + count >= cap").select("name")
        rest = rest.join(F.broadcast(_named(full, "a:").withColumnRenamed("name", "artist_key")), "artist_key", "left_anti")
        barred = rest.select("pos", F.explode(_keys()).alias("name")).join(F.broadcast(_named(full, "k:")), "name", "left_semi").select("pos").distinct()
        rest = checkpointed(rest.join(barred, "pos", "left_anti"))
        before, n = n, rest.count()
        if 2 * n > before:
            break
    return kept if kept is not None else _claims(rest, max_primary, max_associated, "pos"), rest


def greedy_caps(pool: DataFrame, max_primary: int, max_associated: int, pos: str = "rank", walk: int = WALK) -> DataFrame:
    """``pool`` with ``note``: null for rows that are kept, else why they are not.

    Expects note (already vetoed), artist_key and associated_keys (each counts once
    a row), and distinct values of ``pos``; it is read several times, so it should
    be stored. In the order of ``pos`` a row is kept if
    its artist has fewer than ``max_primary`` kept rows, and each of its associated
    keys fewer than ``max_associated``; only kept rows count.

    Pools of more than ``walk`` rows are decided with the same result as a walk. First
    the rows at the head are walked (numeric ``pos`` only) and rows with a name that is
    full by then are dropped, as long as this leaves no more than half of the rows. The
    others are decided in rounds; once no more than ``walk`` rows are kept or undecided, a walk over these
    ends it, as dropped rows do not count. In a round a row is kept when each of its names still has room even if every
    undecided row before it is kept, and dropped when the kept rows before it fill
    one. The first undecided row is always decided, and so is the first of each group
    of rows that share no name with others. Per name only the first few rows matter,
    so a name that a third of all rows share is cut down before it is shuffled. Rows
    that are dropped are told why at the end, from the places at which caps were reached.
    """
    if pool.limit(walk + 1).count() <= walk:
        return _walked(pool, max_primary, max_associated, pos)
    most = max(max_primary, max_associated)
    artist, keys = _artist() != "", F.size(_keys()) > 0
    barred = (artist & F.lit(max_primary < 1)) | (keys & F.lit(max_associated < 1))  # a cap of nothing
    rest = pool.where(F.col("note").isNull() & (artist | keys) & ~barred).select(F.col(pos).alias("pos"), "artist_key", "associated_keys")
    heads = HEADS * walk if isinstance(pool.schema[pos].dataType, NumericType) else 0
    if heads > 0:
        won, rest = _headed(rest, max_primary, max_associated, heads)
        live = checkpointed(won.select("pos", "name", "cap", "place", F.lit(True).alias("kept")).unionByName(_claims(rest, max_primary, max_associated, "pos").withColumn("kept", F.lit(False))))
    else:
        live = checkpointed(_claims(rest, max_primary, max_associated, "pos").withColumn("kept", F.lit(False)))
    total = live.count()
    while True:
        undecided, rows = live.agg(F.count_if(~F.col("kept")), F.count_distinct("pos")).first()
        if undecided and rows <= walk:
            live = checkpointed(_finished(live))
        if not undecided or rows <= walk:
            break
        tops = _filled_at(live, most, "top")  # the last place with room for all that may be kept
        fulls = _filled_at(live.where("kept"), most, "full")
        known = tops.join(fulls, "name", "left")
        counts = live.groupBy("name").agg(F.count(F.lit(1)).alias("c"))
        room = known.join(counts, "name")
        waiting = live.where("not kept")
        # a name below its cap has no row in ``room``: there is room for each of its rows
        judged = join_keyed(waiting, room, "name", total).select("pos", (F.col("pos") <= F.col("top")).alias("fits"), F.coalesce(F.col("pos") > F.col("full"), F.lit(False)).alias("full"))
        free = waiting.select("pos", F.lit(True).alias("fits"), F.lit(False).alias("full"))
        verdict = judged.unionByName(free).groupBy("pos").agg(F.bool_and("fits").alias("fits"), F.bool_or("full").alias("full"))
        decided = verdict.where("fits or full").select("pos", F.col("full").alias("_full"))
        live = checkpointed(live.join(decided, "pos", "left").where(~F.coalesce("_full", F.lit(False))).withColumn("kept", F.col("kept") | F.col("_full").isNotNull()).drop("_full"))
    fulls = checkpointed(_filled_at(live, most, "full"))
    artists = _named(fulls, "a:").select(F.col("name").alias("_artist"), F.col("full").alias("_full"))
    if artists.count() > HUBS:
        artists = artists.limit(0)  # these are told with the other names
    marked = pool.join(F.broadcast(artists), F.col("artist_key") == F.col("_artist"), "left")
    by_artist = F.when(F.col("note").isNull() & (F.col(pos) > F.col("_full")), f"skipped_artist_cap_{max_primary}")
    settled = marked.withColumn("note", F.coalesce("note", by_artist)).where("note is not null")
    others = marked.where(F.coalesce("note", by_artist).isNull()).select(*pool.columns)
    claims = checkpointed(_claims(others, max_primary, max_associated, pos))
    counts = claims.groupBy("name").agg(F.count(F.lit(1)).alias("c"))
    late = join_keyed(claims.where("cap >= 1"), fulls.join(counts, "name"), "name", claims.count()).where(F.col("pos") > F.col("full"))
    late = late.select("pos", "place", "name").unionByName(claims.where("cap < 1").select("pos", "place", "name"))
    first = late.groupBy("pos").agg(F.min(F.struct("place", "name")).alias("_why")).select(F.col("pos").alias("_p"), "_why")
    why = F.when(F.col("_why.place") == 0, f"skipped_artist_cap_{max_primary}").otherwise(F.concat(F.lit(f"skipped_associated_artist_cap_{max_associated}:"), F.substr("_why.name", F.lit(3))))
    told = others.join(first, F.col(pos) == F.col("_p"), "left").withColumn("note", F.when(F.col("_why").isNotNull(), why))
    return settled.select(*pool.columns).unionByName(told.select(*pool.columns))


def curate(
    tracks: DataFrame,
    as_of: str,
    lookback_days: int = 7,
    max_per_artist: int = 2,
    max_per_associated: int = 3,
    skip_variants: bool = True,
    enforce_isrc: bool = True,
    require_link: bool = True,
    pool: int | None = None,
) -> DataFrame:
    """Tracks of the pool with ``note`` (null: kept) and ``playlist_rank`` (from 1, of the kept).

    pool: only so many tracks are looked at (all, if none). Vetoes in order: other version preferred, variant, old code, no link, artist
    cap, associated-artist cap. The preferred version is chosen before the
    other vetoes, so its siblings stay dropped even if it is vetoed.
    """
    bounded = tracks if pool is None else tracks.orderBy("rank").limit(pool)
    link = has_platform_link(F.col("spotify_uri"), F.col("spotify_id"), F.col("soundcloud_track_id"), F.col("soundcloud_url"))
    keyed = bounded.withColumns(
        {
            "artist_key": primary_artist_key(F.col("artist")),
            "associated_keys": associated_artist_keys(F.col("artist"), bag("all_artists"), bag("source_artist_name")),
            "_title": base_version_title(F.col("title")),
        }
    )
    version = F.when((F.col("artist_key") != "") & (F.col("_title") != ""), F.concat_ws("|", "artist_key", "_title"))
    plain = ~extended_version(F.col("title"), F.col("source_article_title"), bag("album_name"))
    marked = preferred_versions(keyed, version, [plain.cast("int"), link.cast("int"), F.col("ranking_score")])
    variant = unwanted_variant(F.col("title"), F.col("source_article_title"), F.col("source_article_url"), F.col("soundcloud_url"), bag("album_name"), bag("tag_list"))
    on = F.lit
    note = (
        F.when(~F.col("preferred"), "skipped_duplicate_version")
        .when(on(skip_variants) & variant, "skipped_unwanted_speed_variant")
        .when(on(enforce_isrc) & isrc_outside_window(bag("isrc"), as_of, lookback_days), "skipped_old_isrc_year")
        .when(on(require_link) & ~link, "skipped_no_verified_platform_link")
    )
    slim = checkpointed(marked.select("rank", note.alias("note"), "artist_key", "associated_keys"))
    decided = checkpointed(greedy_caps(slim, max_per_artist, max_per_associated).select("rank", "note"))
    places = numbered(decided.where("note is null").select("rank"), ["rank"], "playlist_rank")
    return bounded.join(decided.join(places, "rank", "left"), "rank")
