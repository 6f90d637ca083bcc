"""Secret scans over a trigram inverted index, with DataFrame functions only.

Each rule's regex is compiled (on the driver, from its parse tree) to a Boolean
query over lower-case trigrams that every match must contain, brought into
disjunctive form: sets of trigrams, one of which must be wholly present. The
inverted index holds the postings of the trigrams that some rule asks for. Postings are
intersected by counting, for each document and set, how many of the set's
trigrams it has; documents with a full set are candidates of the rule and only
these are verified with the regex. A rule without a mandatory trigram (such as
long hexadecimal runs) scans every text.

Positions count code points from 0; ends are exclusive. Matches are leftmost
and do not overlap within a kind; a match whose secret is too short is dropped
(and its text stays consumed). Letters' case is told apart except where a rule
says otherwise, and then for A-Z only.

Defined results: a null text is the empty text (no spans). Repeated rows each
give a row; extra columns are carried along whatever their names, but for
``spans``, which is replaced. Texts of any length are scanned whole; an empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, quoted

try:
    import re._constants as sre
    import re._parser as sre_parser
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse as sre_parser


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  # what has to be long enough
    least: int = 0
    base: bool = False


#: The base kinds, in the order in which ties are listed.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),  # a run matches whole or not at all
)
#: Kinds that are found besides.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("stripe", r"sk_(?:live|test)_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES

#: Candidates are broadcast up to so many rows (about 40 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 200_000
#: Strings followed exactly while a query is derived.
EXACT_SET = 64

# --- regex -> Boolean trigram query ----------------------------------------------------
# A query in disjunctive form is a set of trigram sets; {()} asks for nothing.

Query = frozenset[frozenset[str]]
ALL: Query = frozenset([frozenset()])


def absorbed(q: Iterable[frozenset[str]]) -> Query:
    """Without sets that contain another set of the query."""
    out: list[frozenset[str]] = []
    for s in sorted(set(q), key=lambda s: (len(s), sorted(s))):
        if not any(o <= s for o in out):
            out.append(s)
    return frozenset(out)


def both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > 512:  # too many sets: the shorter query suffices as a necessary condition
        return min(a, b, key=len)
    return absorbed(x | y for x, y in product(a, b))


def either(a: Query, b: Query) -> Query:
    return absorbed(a | b)


def trigrams_of(strings: Iterable[str]) -> Query:
    """Each string's own trigrams; a string shorter than three asks for nothing."""
    return absorbed(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


@dataclass
class Part:
    """What is known of a sub-pattern: all its strings, or its ends, and a query."""

    exact: frozenset[str] | None
    prefix: frozenset[str]
    suffix: frozenset[str]
    query: Query

    @staticmethod
    def of(strings: Iterable[str]) -> Part:
        s = frozenset(strings)
        return Part(s, s, s, ALL)

    @staticmethod
    def unknown(query: Query = ALL) -> Part:
        e = frozenset([""])
        return Part(None, e, e, query)

    def opened(self) -> Part:
        """The same, with the exact strings put into the query."""
        if self.exact is None:
            return self
        ends = lambda cutter: frozenset(map(cutter, self.exact)) if len(self.exact) <= EXACT_SET else frozenset([""])
        return Part(None, ends(lambda s: s[:2]), ends(lambda s: s[-2:]), both(self.query, trigrams_of(self.exact)))

    def then(self, other: Part) -> Part:
        if self.exact is not None and other.exact is not None and len(self.exact) * len(other.exact) <= EXACT_SET:
            return Part.of(a + b for a, b in product(self.exact, other.exact))
        left, right = self.opened(), other.opened()
        seam = ALL
        a, b = self.suffix if self.exact is None else self.exact, other.prefix if other.exact is None else other.exact
        if len(a) * len(b) <= EXACT_SET:
            seam = trigrams_of(x[-2:] + y[:2] for x, y in product(a, b))
        prefix = frozenset((x + y)[:2] for x, y in product(self.exact, right.prefix)) if self.exact is not None and len(self.exact) * len(right.prefix) <= EXACT_SET else left.prefix
        suffix = frozenset((x + y)[-2:] for x, y in product(left.suffix, other.exact)) if other.exact is not None and len(left.suffix) * len(other.exact) <= EXACT_SET else right.suffix
        return Part(None, prefix, suffix, both(both(left.query, right.query), seam))

    def alt(self, other: Part) -> Part:
        if self.exact is not None and other.exact is not None and len(self.exact | other.exact) <= EXACT_SET:
            return Part.of(self.exact | other.exact)
        left, right = self.opened(), other.opened()
        cap = lambda s: s if len(s) <= EXACT_SET else frozenset([""])
        return Part(None, cap(left.prefix | right.prefix), cap(left.suffix | right.suffix), either(left.query, right.query))


def members(items: list) -> set[str] | None:
    """Lower-case characters of a class; None if they are many or not listed."""
    out: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            out.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < 128:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def analyse(nodes) -> Part:
    part = Part.of([""])
    for op, value in nodes:
        if op is sre.LITERAL:
            new = Part.of([chr(value).lower()])
        elif op is sre.IN:
            found = members(value)
            new = Part.of(found) if found else Part.unknown()
        elif op is sre.BRANCH:
            new = None
            for branch in value[1]:
                new = analyse(branch) if new is None else new.alt(analyse(branch))
        elif op is sre.SUBPATTERN:
            new = analyse(value[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, body = value
            inner = analyse(body)
            if least == 0:
                new = inner.alt(Part.of([""])) if most == 1 else Part.unknown()
            else:
                new = inner
                for _ in range(min(least, 3) - 1):
                    new = new.then(inner)
                if least > 3 or most != least:
                    new = new.opened()
                    new = Part(None, new.prefix, new.suffix if least >= 3 and most == least else frozenset([""]), new.query)
        elif op is sre.AT:
            continue
        else:
            new = Part.unknown()
        part = part.then(new)
    return part


def trigram_query(regex: str) -> Query:
    """Sets of lower-case trigrams; every match of ``regex`` holds one set wholly."""
    return analyse(sre_parser.parse(regex)).opened().query


# --- index, candidates, verification ---------------------------------------------------


def postings(docs: DataFrame, keys: list[str], text_col: str, grams: list[str]) -> DataFrame:
    """The inverted index of ``grams``: one row (trigram, *keys) per document that holds it."""
    low = docs.select(*keys, F.lower(F.col(text_col)).alias("_ss_low"))
    held = F.array_compact(F.array(*[F.when(F.contains("_ss_low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select(*keys, F.explode(held).alias("trigram"))


def candidates(index: DataFrame, keys: list[str], queries: dict[str, Query]) -> DataFrame:
    """(*keys, kinds): the rules of which the document holds a full trigram set."""
    spark = index.sparkSession
    terms = [(kind, n, g, len(s)) for kind, q in queries.items() for n, s in enumerate(sorted(q, key=sorted)) for g in sorted(s)]
    sets = spark.createDataFrame(terms, "kind string, set int, trigram string, need int")  # as many rows as the rules have trigrams
    full = index.join(F.broadcast(sets), "trigram").groupBy(*keys, "kind", "set").agg(F.count_distinct("trigram").alias("n"), F.first("need").alias("need")).where("n = need")
    return full.groupBy(*keys).agg(F.collect_set("kind").alias("_ss_kinds"))  # at most one entry per rule


def rule_spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end>> of a rule's matches: what lies between them tells where they are."""
    rx = F.lit(rule.regex)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    secret = F.regexp_extract_all(text, rx, F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.regex, -1)
    steps = F.zip_with(F.zip_with(whole, secret, lambda m, s: F.struct(F.length(m).alias("m"), F.length(s).alias("s"))), between, lambda ms, gap: F.struct(ms["m"].alias("m"), ms["s"].alias("s"), F.length(gap).alias("gap")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        z = a + x["m"]
        hit = F.struct(a.alias("start"), z.alias("end"))
        grown = F.when(x["s"] >= rule.least, F.array_append(acc["out"], hit)).otherwise(acc["out"])
        return F.struct(z.alias("at"), grown.alias("out"))

    found = F.filter(steps, lambda x: x["m"].isNotNull())
    return F.aggregate(found, start, step, lambda acc: acc["out"])


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array<struct<start, rank, end, kind, base>>, by start, then rule order."""
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    indexed = {k: q for k, q in queries.items() if frozenset() not in q}
    columns = [c for c in docs.columns if c.lower() != "spans"]
    own, raw_text = F.col(f"_ss_doc.{quoted([id_col])[0]}"), F.col(f"_ss_doc.{quoted([text_col])[0]}")
    text = F.coalesce(raw_text, F.lit(""))
    # all of the caller's columns in one, so that none clashes with a name used here
    keyed = docs.select(F.struct(*quoted(docs.columns)).alias("_ss_doc")).withColumn("_ss_k", F.xxhash64(own, raw_text))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    if indexed:
        grams = sorted({g for q in indexed.values() for s in q for g in s})
        keys = keyed.select(own.alias("_ss_i"), F.col("_ss_k").alias("_ss_h"), raw_text.alias("_ss_t"))
        index = postings(keys, ["_ss_i", "_ss_h"], "_ss_t", grams)
        picked = cut(candidates(index, ["_ss_i", "_ss_h"], indexed))
        if picked.count() <= BROADCAST_ROWS:
            picked = F.broadcast(picked)
        keyed = keyed.join(picked, own.eqNullSafe(F.col("_ss_i")) & (F.col("_ss_k") == F.col("_ss_h")), "left")
    parts = []
    for rank, rule in enumerate(rules):
        if rule.kind in indexed:
            todo = F.array_contains("_ss_kinds", rule.kind)
        else:
            todo = text.rlike(rule.regex)  # no mandatory trigram: every text is scanned
        raw = F.when(F.coalesce(todo, F.lit(False)), rule_spans(text, rule)).otherwise(none)
        keyed = keyed.withColumn(f"_ss_{rank}", raw)
        parts.append(labelled(F.col(f"_ss_{rank}"), rank, rule))
    return keyed.select(*[F.col(f"_ss_doc.{c}") for c in quoted(columns)], F.array_sort(F.concat(*parts)).alias("spans"))


def labelled(spans: Column, rank: int, rule: Rule) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind"), F.lit(rule.base).alias("base"))
    )


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[count(r.kind) for r in BASE_RULES], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(found: DataFrame, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """Texts with each (merged) span replaced by ``mark``; ``spans`` is dropped."""
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn(text_col, F.when(F.size("spans") > 0, clean).otherwise(text)).drop("spans")


def duckdb_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The digest in DuckDB SQL: every rule scans every text."""
    lists, counts = [], []
    for rank, r in enumerate(rules):
        rx = r.regex
        if rx.startswith("(?i)"):  # ASCII case only
            rx = re.sub(r"(?<![\\\[A-Za-z-])[a-z](?![-\]])", lambda m: f"[{m[0].upper()}{m[0]}]", rx[4:].split(")")[0]) + ")" + ")".join(rx[4:].split(")")[1:])
        q = rx.replace("'", "''")
        lists.append(
            f"list_filter(list_transform(range(1, len(regexp_extract_all(t, '{q}')) + 1), lambda i: {{'s': "
            f"coalesce(list_sum(list_transform(string_split_regex(t, '{q}')[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(regexp_extract_all(t, '{q}')[1:i-1], lambda x: length(x))), 0)::BIGINT, "
            f"'r': {rank}, 'n': length(regexp_extract_all(t, '{q}')[i]), 'k': '{r.kind}', 'b': {str(r.base).lower()}, 'ok': length(regexp_extract_all(t, '{q}', {r.group})[i]) >= {r.least}}}), lambda y: y.ok)"
        )
    for r in BASE_RULES:
        counts.append(f"len(list_filter(a, lambda y: y.k = '{r.kind}'))::BIGINT AS n_{r.kind}")
    join = lambda x: f"coalesce(array_to_string(list_transform({x}, lambda y: y.k || ':' || y.s || ':' || (y.s + y.n)), ','), '')"
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (SELECT doc_id, list_sort({' || '.join(lists)}) AS a FROM d) "
        f"SELECT doc_id, {', '.join(counts)}, sha256({join('list_filter(a, lambda y: y.b)')}) AS base_sha256, {join('a')} AS spans FROM f"
    )
