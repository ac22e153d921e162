"""Secret scan: a trigram index of the texts, Boolean trigram queries of the rules, exact checks.
DataFrame functions only."""

from __future__ import annotations

import json
import re
from re import _constants as ops  # the pattern parser's node names
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.session import settle

# Kinds, patterns, the group whose length counts, and that length. The first three
# are the base kinds; hex runs shorter than the least length are never part of a longer match, so
# its pattern may ask for the length itself.
BASE = ("assign", "access", "hex")
RULES = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private-key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----", 0, 1),
    ("session-access", r"ASIA[A-Z0-9]{16}", 0, 20),
    ("role-id", r"AROA[A-Z0-9]{16}", 0, 20),
    ("code-host", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("code-host-fine", r"github_pat_[A-Za-z0-9_]{22,}", 0, 33),
    ("ci-host", r"glpat-[A-Za-z0-9_-]{20,}", 0, 26),
    ("chat-bot", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("chat-hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}", 0, 40),
    ("pay-live", r"[sr]k_live_[A-Za-z0-9]{16,}", 0, 24),
    ("pay-test", r"[sr]k_test_[A-Za-z0-9]{16,}", 0, 24),
    ("map-key", r"AIza[A-Za-z0-9_-]{35}", 0, 39),
    ("oauth-token", r"ya29\.[A-Za-z0-9_-]{20,}", 0, 25),
    ("oauth-client", r"[0-9]+-[a-z0-9]{32}\.apps\.googleusercontent\.com", 0, 40),
    ("web-token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    ("mail-key", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}", 0, 36),
    ("list-key", r"key-[0-9a-f]{32}", 0, 36),
    ("package-key", r"npm_[A-Za-z0-9]{36}", 0, 40),
    ("index-key", r"pypi-AgEIcHlwaS5vcmc[A-Za-z0-9_-]{20,}", 0, 40),
    ("model-key", r"sk-(?:proj-|ant-)?[A-Za-z0-9_-]{32,}", 0, 35),
    ("hub-key", r"hf_[A-Za-z]{34}", 0, 37),
    ("cloud-connection", r"DefaultEndpointsProtocol=https;AccountName=[a-z0-9]+;AccountKey=[A-Za-z0-9+/=]{40,}", 0, 80),
    ("shared-signature", r"sig=[A-Za-z0-9%]{43,}%3[Dd]", 0, 46),
    ("droplet", r"do[opr]_v1_[a-f0-9]{64}", 0, 71),
    ("shop", r"shp(?:at|ca|pa|ss)_[a-fA-F0-9]{32}", 0, 38),
    ("phone-api", r"AC[a-f0-9]{32}", 0, 34),
    ("url-login", r"[a-z][a-z0-9+.-]*://[^\x00-\x20/:@]+:([^\x00-\x20/:@]+)@", 1, 3),
    ("bearer", r"(?i:authorization)\x20*:\x20*(?i:bearer)\x20+([A-Za-z0-9._~+/=-]{16,})", 1, 16),
    ("basic", r"(?i:authorization)\x20*:\x20*(?i:basic)\x20+([A-Za-z0-9+/=]{12,})", 1, 12),
    ("vault", r"hvs\.[A-Za-z0-9_-]{24,}", 0, 28),
    ("age-key", r"AGE-SECRET-KEY-1[A-Z0-9]{58}", 0, 74),
    ("bot", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}", 0, 44),
)
MOST_VARIANTS = 64


def _walk(nodes, found: list[set[str]], open_now: set[str], case: bool) -> set[str]:
    """Literal strings that end at this point; runs that a pattern must contain go to ``found``."""

    def shut() -> set[str]:
        found.append(open_now)
        return {""}

    for op, arg in nodes:
        if op is ops.LITERAL:
            open_now = {x + chr(arg).lower() for x in open_now}
        elif op is ops.SUBPATTERN:
            open_now = _walk(arg[3], found, open_now, case)
        elif op is ops.IN and all(o is ops.LITERAL for o, _ in arg) and len(arg) * len(open_now) <= MOST_VARIANTS:
            open_now = {x + chr(c).lower() for x in open_now for _, c in arg}
        elif op is ops.BRANCH:
            ends: set[str] = set()
            pure = True
            for branch in arg[1]:
                inner: list[set[str]] = []
                ends |= _walk(branch, inner, set(open_now), case)
                pure &= not inner
            if pure and len(ends) <= MOST_VARIANTS:
                open_now = ends
            else:
                open_now = shut()
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            least, most, body = arg
            inner: list[set[str]] = []
            once = _walk(body, inner, {""}, case)
            if not inner and (least, most) == (0, 1) and len(open_now) * (1 + len(once)) <= MOST_VARIANTS:
                open_now = open_now | {x + y for x in open_now for y in once}
            else:
                open_now = shut()
        elif op is not ops.AT:
            open_now = shut()
    return open_now


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Alternatives, each a list of lower-case trigrams that a matching text must have; None if the
    pattern has no mandatory trigram. Of the literal runs of a pattern the one with the longest
    shortest variant is used."""
    runs: list[set[str]] = []
    runs.append(_walk(parser.parse(pattern), runs, {""}, False))
    best = max(runs, key=lambda run: min(map(len, run)))
    if min(map(len, best)) < 3:
        return None
    return [sorted({x[i : i + 3] for i in range(len(x) - 2)}) for x in sorted(best)]


def _table(rows: list[dict], kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), F.lit(f"array<struct<{kind}>>"))


def candidates(rows: DataFrame, rules=RULES) -> DataFrame:
    """(key, rules): which rules' trigram queries each text of ``rows`` (key, text) meets."""
    spark = rows.sparkSession
    terms = []
    for number, (_, pattern, _, _) in enumerate(rules):
        for variant, grams in enumerate(trigram_query(pattern) or []):
            terms += [(g, number, variant, 1 << i, (1 << len(grams)) - 1) for i, g in enumerate(grams)]
    vocabulary = sorted({t[0] for t in terms})
    # The index: for each trigram that a query has, the texts that contain it.
    held = F.filter(F.array(*[F.lit(g) for g in vocabulary]), lambda g: F.contains(F.col("low"), g))
    index = settle(
        rows.select("key", F.lower("text").alias("low")).select(F.explode(held).alias("gram"), "key").distinct()
    )
    query = spark.createDataFrame(terms, "gram string, rule int, variant int, bit long, full long")
    met = (
        index.join(F.broadcast(query), "gram")  # as many rows as the rules have trigrams
        .groupBy("key", "rule", "variant").agg(F.bit_or("bit").alias("bits"), F.first("full").alias("full"))
        .where("bits = full")
    )
    return met.groupBy("key").agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def _matches(text: Column, rule: Column) -> Column:
    """Spans of a rule's matches, in code points, end exclusive."""
    whole = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    part = F.when(rule["part"] == 0, whole).when(rule["part"] == 1, F.regexp_extract_all(text, rule["pattern"], F.lit(1))).otherwise(
        F.regexp_extract_all(text, rule["pattern"], F.lit(2))
    )
    gaps = F.split(text, rule["pattern"], -1)
    kind = "array<struct<first:int,rank:int,last:int,kind:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def add(done: Column, x: Column) -> Column:
        first = done["at"] + F.length(x["gap"])
        last = first + F.length(x["hit"]["whole"])
        span = F.struct(first.alias("first"), rule["rank"].alias("rank"), last.alias("last"), rule["kind"].alias("kind"))
        good = F.coalesce(F.length(x["hit"]["part"]) >= rule["least"], F.lit(False))
        return F.struct(last.alias("at"), F.when(good, F.concat(done["out"], F.array(span))).otherwise(done["out"]).alias("out"))

    hits = F.zip_with(whole, part, lambda w, p: F.struct(w.alias("whole"), p.alias("part")))
    pairs = F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    return F.when(F.rlike(text, rule["pattern"]), F.aggregate(pairs, start, add, lambda done: done["out"])).otherwise(F.array().cast(kind))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Secrets in whole texts.

    Returns one row per row of ``docs``: doc_id, spans (array of first, rank, last, kind in code
    points, end exclusive, by first and order of the rules). Matches of a rule are leftmost and do
    not overlap; those whose counted part is too short are dropped afterwards.

    Each rule's pattern is parsed into a Boolean query: alternatives of trigrams that must all
    occur. The index holds, for every trigram of a query, the texts that have it; its postings are
    intersected per text and alternative, and only texts that meet a rule's query are checked
    against its pattern. Rules without a mandatory trigram check every text.

    A null text counts as empty and has no spans. Null ids are kept; each of repeated rows gets its result (texts
    are joined to their candidates by a hash of id and text; if two share one, both are checked).
    Extra columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    made = [{"rank": i, "kind": kind, "pattern": pattern, "part": part, "least": least} for i, (kind, pattern, part, least) in enumerate(rules)]
    kind = "rank:int,kind:string,pattern:string,part:int,least:int"
    table = _table(made, kind)
    scanned = [i for i, rule in enumerate(rules) if trigram_query(rule[1]) is None]
    found = rows.join(candidates(rows, rules), "key", "left").select(
        "doc_id", "text", F.concat(F.coalesce("rules", F.array().cast("array<int>")), F.array(*[F.lit(i) for i in scanned]).cast("array<int>")).alias("rules")
    )
    spans = F.flatten(F.transform("rules", lambda i: _matches(F.col("text"), F.element_at(table, i + 1))))
    return found.select("doc_id", F.array_sort(spans).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


assert all(re.compile(rule[1]) for rule in RULES)
