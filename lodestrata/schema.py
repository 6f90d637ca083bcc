"""Schemas of the records that flow through the engine."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()

#: A release sighting. ``open_graph`` is an open bag of strings (numbers included).
RELEASE = T.StructType(
    [T.StructField(n, _S) for n in ("artist", "track_or_project_title", "release_type")]
    + [T.StructField("confidence_score", _D)]
    + [T.StructField(n, _S) for n in ("extraction_method", "source_article_title", "source_article_url", "source_name", "article_date")]
    + [
        T.StructField("embedded_music_links", T.ArrayType(_S)),
        T.StructField("open_graph", T.MapType(_S, _S)),
        T.StructField("release_article", T.BooleanType()),
    ]
)
#: A sighting that carries its source's own ranking.
RANKED_RELEASE = T.StructType([*RELEASE.fields, T.StructField("ranking_score", _D), T.StructField("ranking_factors", _S)])
#: An article card before extraction.
CARD = T.StructType([T.StructField(n, _S) for n in ("title", "url", "source_name", "category", "publish_date", "snippet")])
