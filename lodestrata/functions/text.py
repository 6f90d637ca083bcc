"""Text normalisation. Unicode folds are Arrow UDFs (Spark has none); the rest is built in."""

from __future__ import annotations

import html
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words and phrases that normalisation drops.
JOINING_WORDS = "feat|ft|featuring|with|x"
MIX_PHRASES = "original mix|extended mix|radio edit|edit|club mix"
VERSION_PHRASES = "extended|extended version|extended mix|radio edit|club mix|original mix|edit|mix|version"
ARTIST_SPLIT = r"(?iU)\s*(?:,|&|\+|\bx\b|\bfeat\.?\b|\bft\.?\b|\bfeaturing\b)\s*"
ALIAS_SPLIT = r"(?iU)\s*(?:,|\bx\b|\bfeat\.?\b|\bft\.?\b|\bfeaturing\b)\s*"


def _arrow(fn, kind=T.StringType()):
    @F.arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        texts = (v.as_py() for v in values)  # one at a time: a batch of whole documents is not held as Python strings
        return pa.array((None if t is None else fn(t) for t in texts), values.type, size=len(values))

    return run


#: NFKD, then everything that is not ASCII is dropped.
ascii_fold = _arrow(lambda s: s if s.isascii() else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())
#: NFKC.
nfkc = _arrow(lambda s: s if s.isascii() else unicodedata.normalize("NFKC", s))
#: NFKD without combining characters.
strip_combining = _arrow(lambda s: s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))
#: HTML entities to characters.
html_unescape = _arrow(html.unescape)


def squeeze(c: Column) -> Column:
    """White space runs to one space, trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean(c: Column) -> Column:
    """Null to empty, then :func:`squeeze`."""
    return squeeze(F.coalesce(c.cast("string"), F.lit("")))


def clean_text(c: Column) -> Column:
    """NFKC, squeezed, without commas, semicolons, colons and hyphens at the ends."""
    return F.regexp_replace(F.regexp_replace(nfkc(c), r"(?U)\s+", " "), r"^[ \t\r\n,;:-]+|[ \t\r\n,;:-]+$", "")


def clean_html(c: Column) -> Column:
    return squeeze(html_unescape(F.coalesce(c, F.lit(""))))


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def normalize_folded(folded: Column) -> Column:
    """The built-in part of :func:`normalize_text`, for text that is ASCII already."""
    return _spaced(F.regexp_replace(F.replace(F.lower(folded), F.lit("&"), F.lit(" and ")), rf"\b({JOINING_WORDS})\b", " "))


def normalize_text(c: Column) -> Column:
    """Folded to ASCII, lower case, ``&`` spelt out, joining words dropped, words spaced by one space."""
    return normalize_folded(ascii_fold(F.coalesce(c.cast("string"), F.lit(""))))


def without_phrases(normalized: Column, phrases: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(normalized, rf"\b({phrases})\b", " "), r"\s+", " "))


def normalize_title(c: Column) -> Column:
    return without_phrases(normalize_text(c), MIX_PHRASES)


def base_version_title(c: Column) -> Column:
    return without_phrases(normalize_text(c), VERSION_PHRASES)


def key_part(c: Column) -> Column:
    """Deduplication key: letters without their marks; what is no ASCII letter or digit spaces words."""
    return _spaced(F.replace(strip_combining(F.lower(clean_text(F.coalesce(c, F.lit(""))))), F.lit("&"), F.lit(" and ")))


def normalize_name(c: Column) -> Column:
    """:func:`normalize_text` that keeps joining words."""
    return _spaced(F.replace(F.lower(ascii_fold(F.coalesce(c.cast("string"), F.lit("")))), F.lit("&"), F.lit(" and ")))


def normalize_artist_name(c: Column) -> Column:
    return _spaced(F.lower(clean_html(c)))


def clean_id(c: Column) -> Column:
    """Trimmed; null when empty or the word none."""
    t = F.trim(c.cast("string"))
    return F.when((t != "") & (F.lower(t) != "none"), t)


def clean_optional(c: Column) -> Column:
    """Squeezed; empty for none, null and nan."""
    t = clean(c)
    return F.when(F.lower(t).isin("none", "null", "nan"), F.lit("")).otherwise(t)


def value_as_str(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def null_if_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in columns])


def unique_nonempty(values: Column) -> Column:
    """Distinct without regard to case; keeps first spellings and their order."""
    cleaned = F.filter(F.transform(values, clean), lambda x: x != "")
    lowered = F.transform(cleaned, F.lower)
    return F.filter(cleaned, lambda x, i: F.array_position(lowered, F.lower(x)) == i + 1)


def without_parens(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", " ")


def primary_artist(c: Column) -> Column:
    """The raw first name of a credit line."""
    return F.element_at(F.split(without_parens(clean(c)), ARTIST_SPLIT, 2), 1)


def primary_artist_key(c: Column) -> Column:
    return normalize_text(primary_artist(c))


def artist_parts(c: Column) -> Column:
    return F.split(without_parens(clean(c)), ARTIST_SPLIT)


def artist_aliases(c: Column) -> Column:
    """Full credit, credit without parentheses, and its names (no split at ``&``)."""
    t = clean(c)
    bare = without_parens(t)
    return unique_nonempty(F.concat(F.array(t, bare), F.split(bare, ALIAS_SPLIT)))


def catalogue_aliases(c: Column) -> Column:
    """As :func:`artist_aliases`, of the credit without parentheses alone."""
    bare = without_parens(clean(c))
    return unique_nonempty(F.concat(F.array(bare), F.split(bare, ALIAS_SPLIT)))


def normalize_all(values: Column) -> Column:
    """:func:`normalize_text` of each entry (joined by a line feed for one Arrow call)."""
    joined = ascii_fold(F.array_join(F.transform(F.coalesce(values, F.expr("cast(array() as array<string>)")), lambda x: F.replace(F.coalesce(x, F.lit("")), F.lit("\n"), F.lit(" "))), "\n"))
    return F.when(F.size(values) > 0, F.transform(F.split(joined, "\n"), normalize_folded)).otherwise(F.expr("cast(array() as array<string>)"))


def associated_artist_keys(artist: Column, all_artists: Column, source_artist: Column) -> Column:
    """Ordered distinct keys of all names in the three credits."""
    names = F.concat(artist_parts(artist), artist_parts(all_artists), artist_parts(source_artist))
    return F.array_distinct(F.filter(normalize_all(names), lambda x: x != ""))


def split_genre_terms(c: Column) -> Column:
    t = F.trim(clean(c), F.lit('"'))
    parts = F.transform(F.split(t, r"[,#/;|]+"), lambda x: squeeze(F.regexp_replace(x, '^["\\s]+|["\\s]+$', "")))
    return F.filter(parts, lambda x: x != "")


def split_artist_title(c: Column, dashes: tuple[str, ...] = (" - ", " – ", " — "), both: bool = True) -> Column:
    """struct(artist, title) split at the first separator, in the order of ``dashes``; else null.

    both: whether both halves have to be filled (else the next separator is tried).
    """
    tries = []
    for d in dashes:
        halves = F.split(c, d, 2)
        pair = F.struct(squeeze(halves[0]).alias("artist"), squeeze(halves[1]).alias("title"))
        ok = F.contains(c, F.lit(d))
        tries.append(F.when(ok & (pair["artist"] != "") & (pair["title"] != ""), pair) if both else F.when(ok, pair))
    return F.coalesce(*tries)


def strip_artist_prefix(title: Column, artist: Column) -> Column:
    """What follows ``artist`` (in any case) and a dash; null if the title does not start so."""
    rest = F.substring(title, F.length(artist) + 1, F.length(title))
    tail = F.regexp_extract(rest, r"(?U)^\s*[-–—]\s*(.+)$", 1)
    return F.when(F.startswith(F.lower(title), F.lower(artist)) & (tail != ""), squeeze(tail))
