"""License scan: ordered signature rules behind a keyword filter, overlaps resolved by containment
and priority. DataFrame functions only."""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word characters and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Label, a word that every name has, names as patterns over words one space apart.
LICENSES = (
    ("mit", "mit", r"mit|mit x11|expat mit"),
    ("apache-2", "apache", r"apache(?: software)?(?: license)?(?: version)?(?: v)? ?(?:2|2 0)|apache 2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("gpl", "gnu", r"gnu general public license|gnu gpl"),
    ("gpl", "gpl", r"gpl"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gnu", r"gnu general public license(?: as published by the free software foundation)? (?:version|v) ?2(?: 0)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gnu", r"gnu general public license(?: as published by the free software foundation)? (?:version|v) ?3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl", "library", r"(?:gnu )?library general public license"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?v?2(?: 1)?(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl ?v?3(?: 0)?(?: only| or later)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public license(?: (?:version|v) ?3(?: 0)?)?"),
    ("agpl-3", "agpl", r"(?:gnu )?agpl(?: ?v?3(?: 0)?)?(?: only| or later)?"),
    ("gfdl", "documentation", r"gnu free documentation license"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? 1 1"),
    ("mpl-2", "mozilla", r"mozilla public license(?:(?: version| v)? 2(?: 0)?)?"),
    ("mpl-2", "mpl", r"mpl ?v?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?:(?: version| v)? 2(?: 0)?)?"),
    ("edl-1", "eclipse", r"eclipse distribution license(?: version| v)? 1(?: 0)?"),
    ("cddl", "cddl", r"cddl(?: version)?(?: 1(?: 0| 1)?)?"),
    ("cddl", "distribution", r"common development and distribution license"),
    ("cpl", "common", r"common public license"),
    ("bsd", "bsd", r"bsd|bsd style"),
    ("bsd-2", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)"),
    ("bsd-3", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)"),
    ("bsd-4", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|0 clause bsd)"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib|zlib libpng"),
    ("boost", "boost", r"boost(?: software)?(?: license)?(?: version)?(?: 1 0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-2", "artistic", r"artistic(?: license)? 2(?: 0)?"),
    ("artistic-1", "artistic", r"artistic(?: license)?(?: 1(?: 0)?)?"),
    ("psf", "python", r"python software foundation"),
    ("php", "php", r"php(?: license)?(?: 3 0 1| 3 01)?"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("ofl", "sil", r"sil open font(?: license)?(?: version)?(?: 1 1)?"),
    ("ofl", "ofl", r"ofl(?: 1 1)?"),
    ("eupl", "eupl", r"eupl(?: v?1 [12])?"),
    ("eupl", "european", r"european union public license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("cecill", "cecill", r"cecill(?: [abc])?"),
    ("osl-3", "open", r"open software license(?: 3(?: 0)?)?"),
    ("afl-3", "academic", r"academic free license(?: 3(?: 0)?)?"),
    ("odbl", "database", r"open (?:data commons open )?database license"),
    ("odbl", "odbl", r"odbl(?: 1 0)?"),
    ("pddl", "pddl", r"pddl"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?(?: international| unported)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative", r"creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("public-domain", "domain", r"public domain"),
    ("proprietary", "proprietary", r"proprietary"),
    ("rail", "rail", r"(?:open ?rail|bigscience rail)(?: m)?"),
)
# Priority (lower wins), weight, a word that the pattern has, pattern around a name.
FRAMES = (
    (0, 1.0, "spdx", r"spdx license identifier {name}"),
    (1, 0.95, "under", r"licen[sc]ed (?:\w+ )?under (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[sc]e)?"),
    (1, 0.9, "under", r"(?:released|distributed|available|published|provided|used|redistributed) under (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[sc]e)?"),
    (2, 0.85, "under", r"under (?:the )?(?:terms of (?:the )?)?(?:{name}) licen[sc]e"),
    (2, 0.85, "terms", r"terms (?:and conditions )?of (?:the )?(?:{name})(?: licen[sc]e)?"),
    (3, 0.6, "licen", r"(?:{name}) licen[sc]e(?:d)?"),
    (3, 0.6, "licen", r"licen[sc]e (?:type )?(?:is )?(?:the )?(?:{name})"),
)


def rules() -> list[dict]:
    """Signature rules in order of priority: every frame around every name."""
    out = []
    for priority, weight, word, frame in FRAMES:
        for label, key, names in LICENSES:
            out.append({
                "rank": len(out), "priority": priority, "weight": weight, "label": label, "key": key, "word": word,
                "pattern": "(?<= )(?:" + frame.replace("{name}", f"(?:{names})") + ")(?= )",
            })
    return out


def _table(given: list[dict]) -> Column:
    kind = "array<struct<rank:int,priority:int,weight:double,label:string,key:string,word:string,pattern:string>>"
    return F.from_json(F.lit(json.dumps(given)), F.lit(kind))


def _gate(text: Column, given: list[dict]) -> Column:
    """Whether a text in lower case has a rule's word or all words of a base phrase. No gap splits a word, so nothing is missed."""
    needs = [(x,) for x in sorted({r["word"].lower() for r in given})] + [tuple(p.split()) for p in PHRASES]
    return reduce(or_, (reduce(and_, (F.contains(text, F.lit(x)) for x in words)) for words in needs))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(line: Column, rule: Column) -> Column:
    """Word intervals of a rule's matches in words that have a space before and after each."""
    found = F.regexp_extract_all(line, rule["pattern"], F.lit(0))
    rest = F.split(line, rule["pattern"], -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def add(done: Column, x: Column) -> Column:
        first = done["at"] + _spaces(x["gap"])
        after = first + _spaces(x["hit"])
        return F.struct(
            after.alias("at"),
            F.when(x["hit"].isNull(), done["out"])
            .otherwise(F.concat(done["out"], F.array(F.struct((first - 1).cast("int").alias("first"), (after - 1).cast("int").alias("last")))))
            .alias("out"),
        )

    pairs = F.zip_with(rest, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    spots = F.when(F.size(found) > 0, F.aggregate(pairs, start, add, lambda done: done["out"]))
    return F.transform(
        F.coalesce(spots, F.array().cast("array<struct<first:int,last:int>>")),
        lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), rule["rank"].alias("rank"),
                           rule["priority"].alias("priority"), rule["weight"].alias("weight"), rule["label"].alias("label")),
    )


def _loses(d: Column, e: Column) -> Column:
    """Whether detection ``d`` gives way to ``e``."""
    inside = (e["first"] <= d["first"]) & (d["last"] <= e["last"])
    longer = e["last"] - e["first"] > d["last"] - d["first"]
    same = (e["first"] == d["first"]) & (e["last"] == d["last"])
    meet = (e["first"] <= d["last"]) & (d["first"] <= e["last"])
    around = (d["first"] <= e["first"]) & (e["last"] <= d["last"])
    return (inside & longer) | (same & (e["rank"] < d["rank"])) | (meet & ~inside & ~around & (e["priority"] < d["priority"]))


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", given: list[dict] | None = None) -> DataFrame:
    """License mentions in whole texts.

    Returns one row per row of ``docs``: doc_id, n_words, base (array of first, last, label: places
    of the fixed phrases, words from 0, last included), found (array of first, last, rank,
    priority, weight, label: what the rules found and nothing displaced).

    A-Z count as lower case; words are runs of other characters than ASCII signs and blanks. A text
    that lacks every rule's word and some word of each base phrase goes no further, and a rule runs only on texts that have both its
    words. Of overlapping detections, one inside a longer one gives way, as does the later rule of
    two with one interval, and of two that overlap in part the one of lesser priority.

    Null and empty texts have no words. A null id is kept. Each of repeated rows gets its result.
    Extra columns are ignored. An empty table gives an empty result. Nothing is shuffled.
    """
    given = rules() if given is None else given
    table = _table(given)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    low = F.lower("text")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), low.alias("low"))
    plain = F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER), GAP, " "))
    rows = rows.select("doc_id", "n_words", F.when(_gate(F.col("low"), given), F.concat(F.lit(" "), plain, F.lit(" "))).alias("line"))
    line = F.col("line")

    phrases = [{"rank": i, "priority": 0, "weight": 1.0, "label": label, "key": phrase.split()[0], "word": phrase.split()[-1],
                "pattern": f"(?<= )(?:{phrase})(?= )"} for i, (phrase, label) in enumerate(PHRASES.items())]
    own = F.filter(_table(phrases), lambda r: F.contains(line, r["key"]) & F.contains(line, r["word"]))
    base = F.flatten(F.transform(own, lambda r: _places(line, r)))
    used = F.filter(table, lambda r: F.contains(line, r["key"]) & F.contains(line, r["word"]))
    rows = rows.select("doc_id", "n_words", F.when(line.isNotNull(), base).alias("base"), F.when(line.isNotNull(), F.flatten(F.transform(used, lambda r: _places(line, r)))).alias("all"))
    none = F.array().cast("array<struct<first:int,last:int,rank:int,priority:int,weight:double,label:string>>")
    rows = rows.select("doc_id", "n_words", F.coalesce("base", none).alias("base"), F.coalesce("all", none).alias("all"))
    stays = F.filter("all", lambda d: ~F.exists("all", lambda e: _loses(d, e)))
    return rows.select(
        "doc_id", "n_words", F.transform("base", lambda x: F.struct(x["first"], x["last"], x["label"])).alias("base"), stays.alias("found")
    )
