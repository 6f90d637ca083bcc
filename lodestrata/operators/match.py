"""Scored matching of records against candidates from catalogues and uploads.

Candidates always come by an equi-join on the query that found them; no pair of
a record and a candidate of another query is ever made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_precision_date, in_window, track_date
from ..functions.text import artist_aliases, catalogue_aliases, clean, normalize_all, normalize_name, normalize_text, normalize_title, split_artist_title, unique_nonempty
from ..functions.urls import catalogue_track_id, upload_track_id, upload_track_url
from .components import checkpointed, join_stored
from .dedupe import first_per_key

# Thresholds and the mark of trusted cache rows.
CATALOGUE_LEAST, CATALOGUE_BEST = 0.82, 0.84
UPLOAD_LEAST, UPLOAD_BEST = 0.72, 0.76
USER_LEAST = 0.86
LOOKUP_LEAST = 0.72
TRUSTED_VERSION = "strict_v3_date_checked"


def catalogue_title_score(target: Column, candidate: Column) -> Column:
    inside = F.contains(candidate, target) | F.contains(target, candidate)
    return F.when(candidate == target, 1.0).when((F.length(target) >= 6) & inside, 0.86).otherwise(0.0)


def upload_title_score(target: Column, candidate: Column, everything: Column) -> Column:
    filled = target != ""
    return F.when(candidate == target, 1.0).when(filled & F.contains(candidate, target), 0.86).when(filled & F.contains(everything, target), 0.74).otherwise(0.0)


def artist_score(targets: Column, candidates: Column) -> Column:
    """Best pair of names: 1 if equal, 0.84 if one holds the other and both have five letters."""

    def pair(a: Column, b: Column) -> Column:
        long = (F.length(a) >= 5) & (F.length(b) >= 5)
        return F.when(a == b, 1.0).when(long & (F.contains(a, b) | F.contains(b, a)), 0.84).otherwise(0.0)

    each = F.transform(targets, lambda a: F.coalesce(F.array_max(F.transform(candidates, lambda b: pair(a, b))), F.lit(0.0)))
    return F.coalesce(F.array_max(each), F.lit(0.0))


def filled(values: Column) -> Column:
    return F.filter(values, lambda x: F.coalesce(x, F.lit("")) != "")


def combined(title: Column, artist: Column, popularity: Column) -> Column:
    return title * 0.55 + artist * 0.40 + popularity * 0.05


def catalogue_names(tracks: DataFrame) -> DataFrame:
    """Tracks with _ct and _ca, the normalised title and artists, which need no query."""
    return tracks.withColumns({"_ct": normalize_title(F.col("name")), "_ca": normalize_all(filled(F.col("artist_names")))})


def first_rows(rows: DataFrame, keys: list[str], pos: str, n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark keeps no more of a key in a task before it shuffles."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(pos))).where(F.col("_n") <= n).drop("_n")


def _best(scored: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each query: by score, then by ``pos``."""
    if most == 1:
        return first_per_key(scored, ["query_id"], [-F.col("score"), F.col("pos")])
    order = Window.partitionBy("query_id").orderBy(-F.col("score"), "pos")
    return scored.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")


def best_other(asked: DataFrame, rows: DataFrame, by: list[str], keyed_by: list[str], named, best_two) -> DataFrame:
    """(query_id, best, score): the best other row for each row of ``asked`` among the ``rows`` that agree with it in ``by``.

    asked: query_id, the columns ``keyed_by`` and ``by``; queries that are equal in both are
    judged once. rows: pos, the columns ``by``, and what a candidate is scored by; of rows that are
    equal but for ``pos``, the first two stand for all, as nothing but its own
    row is closed to a query. named(rows): rows with their normalised names. best_two(queries, candidates): the two best of each query, with score.
    """
    mark = F.md5(F.to_json(F.struct(*keyed_by, *by), {"ignoreNullFields": "false"}))
    own = asked.withColumn("_class", mark)
    classes = own.select("_class", *keyed_by, *[c for c in by if c not in keyed_by]).dropDuplicates(["_class"]).withColumnRenamed("_class", "query_id")
    same = [c for c in rows.columns if c != "pos"]
    firsts = named(first_rows(rows, same, "pos", 2))
    found = best_two(classes, classes.select("query_id", *by).join(firsts, by).drop(*by))
    two = found.groupBy(F.col("query_id").alias("_class")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), "pos", "score"))).alias("_two"))
    joined = join_stored(checkpointed(own.select("query_id", "_class")), two, "_class")
    best = F.try_element_at(F.filter("_two", lambda x: x["pos"] != F.col("query_id")), F.lit(1))
    return joined.select("query_id", best.alias("b")).where("b is not null").select("query_id", F.col("b.pos").alias("best"), F.col("b.score").alias("score"))


def best_catalogue_match(queries: DataFrame, candidates: DataFrame, as_of: str, days: int, most: int = 1) -> DataFrame:
    """The best catalogue track (or the ``most`` best) of each query, where one is good enough.

    queries: query_id, artist, title. candidates: query_id, pos, name,
    artist_names (array), popularity, release_date, release_date_precision and
    whatever is to be handed through. Dates have to be known and in the window.
    The first of equal scores wins. Returns the candidate's columns and score.
    """
    asked = queries.select("query_id", normalize_title(F.col("title")).alias("_tt"), normalize_all(catalogue_aliases(F.col("artist"))).alias("_ta"))
    named = candidates if "_ct" in candidates.columns else catalogue_names(candidates)
    scored = named.join(asked, "query_id")
    scored = scored.withColumns({"_ts": catalogue_title_score(F.col("_tt"), F.col("_ct")), "_as": artist_score(F.col("_ta"), F.col("_ca"))})
    dated = in_window(day_precision_date(F.col("release_date"), F.col("release_date_precision")), as_of, days, False)
    good = scored.where((F.col("_ts") >= CATALOGUE_LEAST) & (F.col("_as") >= CATALOGUE_LEAST) & dated)
    good = good.withColumn("score", combined(F.col("_ts"), F.col("_as"), F.coalesce(F.col("popularity"), F.lit(0)) / 100.0))
    return _best(good, most).where(F.col("score") >= CATALOGUE_BEST).drop("_tt", "_ta", "_ct", "_ca", "_ts", "_as")


NO_NAMES = "cast(array() as array<string>)"


def with_artists(uploads: DataFrame) -> DataFrame:
    """Uploads with _ia, the uploader's names (publisher's artist and composer, user's name and link), and
    _ca, those and the artist before a dash in the title.

    The Unicode fold is a column of its own first: it cannot stand inside a lambda.
    """
    prefix = split_artist_title(clean(F.col("title")), both=False)["artist"]
    folded = uploads.withColumns(
        {
            "_names": normalize_all(filled(F.array("publisher_artist", "writer_composer", "username", "permalink"))),
            "_prefix": normalize_all(filled(F.array(prefix))),
        }
    )
    own = folded.withColumn("_ia", unique_nonempty(F.col("_names")))
    return own.withColumn("_ca", unique_nonempty(F.concat("_names", "_prefix"))).drop("_names", "_prefix")


def upload_names(uploads: DataFrame) -> DataFrame:
    """Uploads with _ct, the normalised title, and the names of :func:`with_artists`, which need no query."""
    return with_artists(uploads.withColumn("_ct", normalize_title(F.col("title"))))


def upload_checks(candidates: DataFrame, asked: DataFrame, as_of: str, days: int) -> DataFrame:
    """Candidates with _ts, _as, _is (title, artist, identity) that pass all thresholds and the date."""
    named = (candidates if "_ct" in candidates.columns else upload_names(candidates)).join(asked, "query_id")
    everything = normalize_text(F.concat(F.array_join("_ca", " "), F.lit(" "), F.col("_ct")))
    scored = named.withColumn("_all", everything).withColumns(
        {"_ts": upload_title_score(F.col("_tt"), F.col("_ct"), F.col("_all")), "_as": artist_score(F.col("_ta"), F.col("_ca")), "_is": artist_score(F.col("_ta"), F.col("_ia"))}
    )
    day = track_date(F.col("release_year"), F.col("release_month"), F.col("release_day"), F.col("release_date"), F.col("display_date"), F.col("created_at"))
    good = (F.col("_ts") >= UPLOAD_LEAST) & (F.col("_as") >= UPLOAD_LEAST) & (F.col("_is") >= UPLOAD_LEAST)
    return scored.where(good & in_window(day, as_of, days, True))


_WORK = ["_tt", "_ta", "_ct", "_ca", "_ia", "_all", "_ts", "_as", "_is"]


def best_upload_match(queries: DataFrame, candidates: DataFrame, as_of: str, days: int, most: int = 1) -> DataFrame:
    """The best upload (or the ``most`` best) of each query; an unknown date passes.

    candidates: query_id, pos, title, publisher_artist, writer_composer,
    username, permalink, playback_count, release_year, release_month,
    release_day, release_date, display_date, created_at, and more.
    """
    asked = queries.select("query_id", normalize_title(F.col("title")).alias("_tt"), filled(normalize_all(artist_aliases(F.col("artist")))).alias("_ta"))
    good = upload_checks(candidates, asked, as_of, days)
    plays = F.least(F.coalesce(F.col("playback_count"), F.lit(0)) / 1_000_000.0, F.lit(1.0))
    good = good.withColumn("score", combined(F.col("_ts"), F.col("_as"), plays))
    return _best(good, most).where(F.col("score") >= UPLOAD_BEST).drop(*_WORK)


def search_queries(artist: Column, title: Column, most: int = 4) -> Column:
    """Search texts: each of the first aliases with the title."""
    return unique_nonempty(F.transform(F.slice(artist_aliases(artist), 1, most), lambda a: F.concat(a, F.lit(" "), title)))


def candidate_union(found: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """Candidates by key: the last version of each, at the place where it first occurred."""
    return found.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in found.columns if c not in keys]), pos).alias("_r"), F.min(pos).alias("_p")).select(*keys, "_r.*", "_p").drop(pos).withColumnRenamed("_p", pos)


def profile_candidates(queries: DataFrame, users: DataFrame, tracks: DataFrame) -> DataFrame:
    """Tracks of the users that a query's artist is likely to be (identity score 0.86 and more).

    users: query_id, user_id, username, permalink, full_name; tracks: user_id, pos, ...
    """
    asked = queries.select("query_id", filled(normalize_all(artist_aliases(F.col("artist")))).alias("_ta"))
    names = normalize_all(filled(F.array("username", "permalink", "full_name")))
    likely = users.withColumn("_n", names).join(asked, "query_id").where(artist_score(F.col("_ta"), F.col("_n")) >= USER_LEAST)
    return likely.select("query_id", "user_id").distinct().join(tracks, "user_id")


def user_score(name: Column) -> Column:
    """How well a user fits an artist's name: name, link, followers, verification.

    Fixed values: the points of each and the steps of followers.
    """
    target, user, link = normalize_name(name), normalize_name(F.col("username")), normalize_name(F.col("permalink"))
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    n = F.coalesce(F.col("followers_count"), F.lit(0))
    held = (target != "") & (F.contains(user, target) | F.contains(target, user))
    score = (
        F.when(user == target, 0.65).when(held, 0.35).otherwise(0.0)
        + F.when(link == target, 0.25).when((target != "") & (bare(target) == bare(link)), 0.20).otherwise(0.0)
        + F.when(n >= 100_000, 0.10).when(n >= 10_000, 0.06).when(n >= 1_000, 0.03).otherwise(0.0)
        + F.when(F.col("verified"), 0.10).otherwise(0.0)
    )
    return F.least(score, F.lit(1.0))


def best_user(queries: DataFrame, users: DataFrame) -> DataFrame:
    """The best user of each artist name; the last of equals wins."""
    usable = users.where((F.coalesce(F.col("id").cast("string"), F.lit("")) != "") & (F.coalesce(F.col("permalink_url"), F.lit("")) != ""))
    scored = usable.join(queries.select("query_id", "artist"), "query_id").withColumn("score", user_score(F.col("artist")))
    best = first_per_key(scored, ["query_id"], [-F.col("score"), -F.col("pos")])
    return best.where(F.col("score") >= LOOKUP_LEAST).withColumn("score", F.round("score", 3))


def first_hit(found: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    return found.groupBy(key).agg(F.min_by(value, pos).alias(value))


def last_wins_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: str) -> DataFrame:
    """Inner equi-join on the last right row of each key."""
    last = first_per_key(right.withColumn("_rk", F.col(right_key)), ["_rk"], [-F.col(order)])
    return left.join(last.drop("_rk"), left[left_key] == last[right_key])


def cache_lookup(records: DataFrame, cache: DataFrame, key: str = "cache_key") -> DataFrame:
    """Records with what the cache knows under their key (null where it knows nothing)."""
    return records.join(cache, key, "left")


def trusted_catalogue(version: Column) -> Column:
    return F.coalesce(version == TRUSTED_VERSION, F.lit(False))


def trusted_uploads(cached: DataFrame, payloads: DataFrame, as_of: str, days: int) -> DataFrame:
    """query_id of cached uploads whose present payload still passes all checks.

    cached: query_id, artist, title, soundcloud_track_id. payloads: as the
    candidates of :func:`best_upload_match`, with soundcloud_track_id.
    """
    names = F.filter(F.split("artist", ","), lambda x: F.trim(x) != "")
    asked = cached.select("query_id", normalize_title(F.col("title")).alias("_tt"), normalize_all(F.when(F.size(names) > 0, names).otherwise(F.array("artist"))).alias("_ta"))
    found = cached.select("query_id", "soundcloud_track_id").join(payloads.drop("query_id"), "soundcloud_track_id")
    return upload_checks(found, asked, as_of, days).select("query_id")


_EMPTY = "cast(array() as array<string>)"


def distrusted(records: DataFrame, payloads: DataFrame | None, as_of: str, days: int) -> DataFrame:
    """Cached links that are not trusted become null, with a note for each.

    records: query_id, artist, title, spotify_id, spotify_uri,
    spotify_match_version, soundcloud_track_id, soundcloud_url. payloads: what
    the uploads with the cached identifiers say now (see
    :func:`trusted_uploads`); without it no cached upload is trusted.
    """
    held_u = F.coalesce("soundcloud_track_id", F.lit("")) != ""
    if payloads is None:
        checked = records.withColumn("_good", F.lit(False))
    else:
        asked = records.where(held_u).select("query_id", "artist", "title", "soundcloud_track_id")
        good = trusted_uploads(asked, payloads, as_of, days).distinct().withColumn("_good", F.lit(True))
        checked = records.join(good, "query_id", "left").withColumn("_good", F.coalesce("_good", F.lit(False)))
    bad_u = held_u & ~F.col("_good")
    bad_c = (F.coalesce("spotify_id", F.lit("")) != "") & ~trusted_catalogue(F.col("spotify_match_version"))
    notes = F.array_compact(F.array(F.when(bad_u, "discarded_untrusted_cached_soundcloud_match"), F.when(bad_c, "discarded_legacy_cached_spotify_match")))
    drop = lambda bad, c: F.when(~bad, F.col(c))
    return checked.withColumns(
        {
            "notes": notes,
            **{c: drop(bad_c, c) for c in ("spotify_id", "spotify_uri")},
            **{c: drop(bad_u, c) for c in ("soundcloud_track_id", "soundcloud_url")},
        }
    ).drop("_good", "spotify_match_version")


def resolve_catalogue(records: DataFrame, found: DataFrame, looked_up: DataFrame | None, as_of: str, days: int) -> DataFrame:
    """(query_id, _c): the catalogue track of each record that has an artist and a title.

    A record that names a track is judged on that track alone (looked_up: tracks
    by ``id``); any other on what its search found (query_id, pos, ...).
    """
    named = records.where((clean(F.col("artist")) != "") & (clean(F.col("title")) != "")).withColumn("_d", catalogue_track_id(F.col("open_graph")["spotify_track_id"], F.col("source_article_url"), F.col("embedded_music_links")))
    by_search = best_catalogue_match(named.where("_d = ''"), found, as_of, days).select("query_id", F.col("id").alias("_c"))
    if looked_up is None:
        return by_search
    direct = named.where("_d <> ''")
    own = direct.select("query_id", F.col("_d").alias("id")).join(looked_up, "id").withColumn("pos", F.lit(0))
    return by_search.unionByName(best_catalogue_match(direct, own, as_of, days).select("query_id", F.col("id").alias("_c")))


def resolve_uploads(records: DataFrame, found: DataFrame, looked_up: DataFrame | None, users: DataFrame | None, user_tracks: DataFrame | None, as_of: str, days: int) -> DataFrame:
    """(query_id, _u, _uu): identifier and address of each record's upload.

    A record that gives an address is settled by it: with its own identifier, or
    the one that the address leads to (looked_up: url, kind, id, permalink_url).
    Others take the best of what was found, else the best among the tracks of
    users who are likely to be the artist.
    """
    named = records.withColumns({"_du": upload_track_url(F.col("source_article_url"), F.col("embedded_music_links")), "_di": F.nullif(upload_track_id(F.col("open_graph")["soundcloud_track_id"]), F.lit(""))})
    direct = named.where("_du <> ''").select("query_id", "_du", "_di")
    if looked_up is None:
        settled = direct.select("query_id", F.col("_di").alias("_u"), F.col("_du").alias("_uu"))
    else:
        known = first_per_key(looked_up.where("kind = 'track'").select(F.col("url").alias("_du"), F.col("id").cast("string").alias("_ri"), F.col("permalink_url").alias("_rp")), ["_du"], [F.col("_ri")])
        both = direct.join(known, "_du", "left")
        address = F.when(F.col("_di").isNull(), F.coalesce(F.nullif("_rp", F.lit("")), "_du")).otherwise(F.col("_du"))
        settled = both.select("query_id", F.coalesce("_di", "_ri").alias("_u"), address.alias("_uu"))
    open_ = named.where("_du = ''").where((clean(F.col("artist")) != "") & (clean(F.col("title")) != "")).select("query_id", "artist", "title")
    picked = ["query_id", F.col("id").cast("string").alias("_u"), F.col("permalink_url").alias("_uu")]
    hits = best_upload_match(open_, found, as_of, days).select(*picked)
    out = settled.unionByName(hits)
    if users is None or user_tracks is None:
        return out
    missed = open_.join(hits.select("query_id"), "query_id", "left_anti")
    others = candidate_union(profile_candidates(missed, users, user_tracks).drop("user_id"), ["query_id", "id"], "pos")
    return out.unionByName(best_upload_match(missed, others, as_of, days).select(*picked))


def breaker(asked: DataFrame, refusals: DataFrame, pos: str = "rank", key: str = "interface", id_col: str = "query_id") -> DataFrame:
    """``asked`` with ``breaker``: rate_limited for the first call of each interface that was refused, deferred for all after it, else null.

    asked: the calls that are made (``id_col``, ``pos``, ``key``); a recorded refusal of
    a call that is not made does not count. The first refusal is a minimum by
    interface, reduced in the tasks; no order of all calls is needed.
    """
    refused = refusals.select(F.col(id_col).alias("_id"), F.col(key).alias("_key")).distinct()
    hit = asked.join(refused, (F.col(id_col) == F.col("_id")) & (F.col(key) == F.col("_key")), "left_semi")
    first = hit.groupBy(F.col(key).alias("_key")).agg(F.min(pos).alias("_first"))  # a row for each interface
    known = asked.join(first, F.col(key) == F.col("_key"), "left")
    state = F.when(F.col(pos) == F.col("_first"), "rate_limited").when(F.col(pos) > F.col("_first"), "deferred")
    return known.withColumn("breaker", state).drop("_key", "_first")


def resolve(
    records: DataFrame,
    catalogue: DataFrame,
    uploads: DataFrame,
    as_of: str,
    days: int,
    limited_from: int | None = None,
    catalogue_tracks: DataFrame | None = None,
    upload_addresses: DataFrame | None = None,
    users: DataFrame | None = None,
    user_tracks: DataFrame | None = None,
    refusals: DataFrame | None = None,
) -> DataFrame:
    """Links of ranked records: cached ones, else direct ones, else the best matches.

    records: rank, query_id, artist, title, open_graph, source_article_url,
    embedded_music_links, spotify_id, spotify_uri, soundcloud_track_id,
    soundcloud_url (what the cache gave), perhaps notes, and more. limited_from:
    the rank at which the catalogue began to refuse; from there on catalogue
    links are deferred, with a note. refusals (query_id): the calls that the catalogue
    refused, from which that rank is found (see :func:`breaker`). The other tables are
    recorded lookups.
    """
    if refusals is not None:
        calls = records.where(F.coalesce("spotify_uri", "spotify_id", F.lit("")) == "").select("query_id", "rank", F.lit("catalogue").alias("interface"))
        states = breaker(calls, refusals.select("query_id", F.lit("catalogue").alias("interface"))).where("breaker is not null").select("query_id", "breaker")
        records = records.join(states, "query_id", "left")
        limited, first = F.col("breaker").isNotNull(), F.col("breaker") == "rate_limited"
    else:
        limited = F.lit(False) if limited_from is None else F.col("rank") >= limited_from
        first = F.col("rank") == (limited_from or -1)
    open_c = records.where(F.coalesce("spotify_id", F.lit("")) == "").where(~limited)
    open_u = records.where(F.coalesce("soundcloud_track_id", F.lit("")) == "")
    by_catalogue = resolve_catalogue(open_c, catalogue, catalogue_tracks, as_of, days)
    by_upload = resolve_uploads(open_u, uploads, upload_addresses, users, user_tracks, as_of, days)
    out = records.join(by_catalogue, "query_id", "left").join(by_upload, "query_id", "left")
    refused = limited & (F.coalesce("spotify_id", F.lit("")) == "")
    note = F.when(refused, F.when(first, "spotify_resolution_rate_limited").otherwise("spotify_resolution_deferred"))
    before = F.col("notes") if "notes" in records.columns else F.expr(_EMPTY)
    cached = lambda c: F.nullif(c, F.lit(""))
    return out.withColumns(
        {
            "spotify_id": F.coalesce(cached("spotify_id"), "_c"),
            "spotify_uri": F.coalesce(cached("spotify_uri"), F.concat(F.lit("spotify:track:"), F.coalesce(cached("spotify_id"), "_c"))),
            "soundcloud_track_id": F.coalesce(cached("soundcloud_track_id"), "_u"),
            "soundcloud_url": F.coalesce(cached("soundcloud_url"), "_uu"),
            "notes": F.concat(before, F.array_compact(F.array(note))),
        }
    ).drop("_c", "_u", "_uu", "breaker")


def backlog(resolved: DataFrame, logged_at: str) -> DataFrame:
    """Records whose catalogue link was put off."""
    put_off = F.exists("notes", lambda n: F.startswith(n, F.lit("spotify_resolution_")))
    return resolved.where(put_off).select("rank", "artist", "title", F.lit(logged_at).alias("logged_at"))
