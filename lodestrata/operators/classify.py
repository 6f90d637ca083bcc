"""Rule-based classification of article titles as release news."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import squeeze

# Keyword lists and patterns, by profile.
RELEASE_KEYWORDS_A = (
    "new single", "new track", "new ep", "new album", "new remix", "latest single", "latest album", "newest single", "newest album", "debut single", "debut album",
    "debut ep", "single", "track", "ep", "album", "remix", "rework", "release", "releases", "released", "drops", "delivers", "unveils", "reveals", "unleashes", "present",
    "presents", "shares", "returns with", "joins forces", "join forces", "joins", "teams up", "collaborates", "collide for", "collides for", "unite on", "unites on",
    "reunite for", "reunites for", "listen",
)
RELEASE_KEYWORDS_C = (
    "new single", "new track", "new ep", "new album", "new remix", "debut single", "debut album", "debut ep", "single", "track", "ep", "album", "remix", "rework", "release",
    "releases", "released", "drops", "delivers", "unveils", "shares", "returns with", "joins forces", "join forces", "teams up", "collaborates", "listen",
)
EXCLUDE_KEYWORDS_A = (
    "festival", "lineup", "line-up", "tour", "residency", "interview", "anniversary", "turns", "years old", "dies", "dead", "lawsuit", "legal", "announces", "ranking",
    "ranked", "best of", "gear", "plugin", "business", "industry", "classic", "playlist", "fresh picks", "on-deck circle", "roundup", "radio show", "live set", "livestream",
    "live stream", "watch", "teases",
)
ROUNDUP_KEYWORDS = ("fresh picks", "on-deck circle", "roundup")
CLEAR_DROP_A = (
    r"\b(?:drops?|dropped|releases?|released|delivers?|unveils?|reveals?|unleash(?:es)?|presents?|shares?|returns with|unites? on|reunites? for|joins? .*? with)\b",
    r"\bnew\s+(?:single|track|ep|album|remix|rework)\b",
    r"\b(?:latest|newest)\s+(?:single|track|ep|album|remix|rework)\b",
    r"\b(?:single|track|ep|album|remix|rework)\s+[\"'‘“]",
)
CLEAR_DROP_C = (
    r"\b(?:drops?|dropped|releases?|released|delivers?|unveils?|shares?|returns with)\b",
    r"\bnew\s+(?:single|track|ep|album|remix|rework)\b",
    r"\b(?:single|track|ep|album|remix|rework)\s+[\"'‘“]",
)
CONCRETE_VERB = r"\b(?:drops?|dropped|releases?|released|delivers?|unveils?|reveals?|presents?|shares?|returns with)\b"
QUOTED = r"[\"'‘’“”][^\"'‘’“”]{2,120}[\"'‘’“”]"

RELEASE_KEYWORDS = {"A": RELEASE_KEYWORDS_A, "B": RELEASE_KEYWORDS_A, "C": RELEASE_KEYWORDS_C}
EXCLUDE_KEYWORDS = {
    "A": EXCLUDE_KEYWORDS_A,
    "B": tuple(k for k in EXCLUDE_KEYWORDS_A if k not in ROUNDUP_KEYWORDS),
    "C": tuple(k for k in EXCLUDE_KEYWORDS_A if k not in ROUNDUP_KEYWORDS),
}
CLEAR_DROP = {"A": CLEAR_DROP_A, "B": CLEAR_DROP_A, "C": CLEAR_DROP_C}


def normalized(text: Column) -> Column:
    return F.lower(squeeze(text))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def signals(text: Column, keywords: tuple[str, ...]) -> Column:
    """The keywords that occur as whole words, in the list's order."""
    # the plain search is fast and leaves few texts to the expression
    found = lambda low: [F.when(F.contains(low, F.lit(k)) & low.rlike(rf"(?U)(?<!\w)\Q{k}\E(?!\w)"), F.lit(k)) for k in keywords]
    return once(normalized(text), lambda low: F.array_compact(F.array(*found(low))))


def has_quoted_title(text: Column) -> Column:
    return text.rlike(QUOTED)


def clearly_dropped(text: Column, profile: str = "A") -> Column:

    def any_of(low: Column) -> Column:
        out = F.lit(False)
        for p in CLEAR_DROP[profile]:
            out = out | low.rlike("(?iU)" + p)
        return out

    return once(normalized(text), any_of)


def combined_text(title: Column, snippet: Column) -> Column:
    return F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(snippet, F.lit("")))


def classify(title: Column, snippet: Column | None = None, profile: str = "A") -> Column:
    """struct(release_article, confidence_score, include_signals, exclusion_signals, clearly_dropped).

    Null titles and snippets count as empty.
    """
    title = F.coalesce(title, F.lit(""))
    text = combined_text(title, F.lit(None).cast("string") if snippet is None else snippet)
    facts = F.struct(
        text.alias("text"),
        normalized(title).alias("low"),
        signals(text, RELEASE_KEYWORDS[profile]).alias("include"),
        signals(text, EXCLUDE_KEYWORDS[profile]).alias("exclude"),
        clearly_dropped(text, profile).alias("dropped"),
        has_quoted_title(text).alias("quoted"),
    )
    return once(facts, lambda f: _judged(f, profile))


def _judged(facts: Column, profile: str) -> Column:
    text, low, include, exclude, dropped = (facts[n] for n in ("text", "low", "include", "exclude", "dropped"))
    held_back = (F.size(exclude) > 0) & ~dropped
    listen = F.contains(low, F.lit(": listen"))
    raw = (
        F.when(listen | F.endswith(low, F.lit(" listen")), 0.25).otherwise(0.0)
        + F.when(F.size(include) > 0, 0.25).otherwise(0.0)
        + F.when(facts["quoted"], 0.20).otherwise(0.0)
        + F.when(dropped, 0.15).otherwise(0.0)
        - F.when(held_back, 0.30).otherwise(0.0)
    )
    score = F.greatest(F.lit(0.0), F.least(raw, F.lit(1.0)))
    release = (F.size(include) > 0) & (score >= 0.30) & ~held_back
    vetoes: list[tuple[Column, str]] = []
    if profile in "AB":
        vague = F.array_contains(exclude, "announces") & ~text.rlike("(?iU)" + CONCRETE_VERB)
        release, score = release & ~vague, F.when(vague, F.least(score, F.lit(0.25))).otherwise(score)
        vetoes.append((F.startswith(low, F.lit("[watch]")) | F.startswith(low, F.lit("watch ")), "watch"))
    if profile == "A":
        vetoes.append((F.contains(low, F.lit("fresh picks")) | F.contains(low, F.lit("on-deck circle")), "roundup"))
        vetoes.append((F.contains(low, F.lit("next single")) & ~listen, "next single"))
    noted = exclude
    for veto, name in reversed(vetoes):
        release = F.when(veto, F.lit(False)).otherwise(release)
        score = F.when(veto, F.lit(0.0)).otherwise(score)
        noted = F.when(veto, F.array_distinct(F.array_append(exclude, F.lit(name)))).otherwise(noted)
    return F.struct(
        release.alias("release_article"),
        score.alias("confidence_score"),
        include.alias("include_signals"),
        noted.alias("exclusion_signals"),
        dropped.alias("clearly_dropped"),
    )
