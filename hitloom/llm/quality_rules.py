"""Quality rules: text counts, fixed limits, and robust multivariate outliers per language and source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.llm.words import shipped
from hitloom.session import settle

# The counted symbols, ASCII white space, and the base limits.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20

SHARE = 0.75  # of a group's rows that the estimate is to fit
TAIL = 1e-6  # chance that a row of a normal law is rejected
LEAST_GROUP = 50  # smaller groups are pooled by language, then altogether
MOST_STEPS = 12
STILL = 0.05  # change of the logarithm of a determinant that ends the steps
BINS = 32  # of a factor e of squared distances
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Transformed statistics and the least spread each is given: what ordinary writing varies by, such
#: as a factor e of length, one repeated line of ten, or a repeated passage of a sixteenth.
VECTOR = {"length": 1.0, "word_size": 0.1, "symbols": 0.1, "dup_lines": 0.3, "repeats": 0.25, "line_size": 0.7, "variety": 0.1}
#: Word size is taken as if so many words of so many characters came on top: short texts vary more.
PRIOR_WORDS, PRIOR_SIZE = 30, 5
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    run = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == n:
        return 0
    key, width = run, 1
    while width < window:  # number the runs of growing width, so that equal numbers mean equal runs
        wider = min(2 * width, window)
        m = n - wider + 1
        key = np.unique(key[:m] * np.int64(n + 1) + key[wider - width : wider - width + m], return_inverse=True)[1]
        width = wider
    often = np.bincount(key)[key] > 1
    covered = np.zeros(n, dtype=bool)
    for i in range(window):
        covered[i : i + len(often)] |= often
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word, distinct words."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [counts(x) for x in batch.column("__text").to_pylist()]
        table = np.array(rows, dtype=np.int64).reshape(-1, 7)
        kept = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in kept] + [pa.array(table[:, i], pa.int64()) for i in range(7)],
            names=[batch.schema.names[i] for i in kept] + [*COUNTS, "n_lines", "n_distinct"],
        )


def with_counts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The named columns of ``docs`` and, for each row, the counts of its whole text (null: empty)."""
    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    made = ", ".join(f"{c} long" for c in (*COUNTS, "n_lines", "n_distinct"))
    return given.mapInArrow(_counted, ", ".join(x for x in (kept, made) if x))


def vector() -> list[Column]:
    """Transformed statistics: logarithms of sizes, roots of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    values = [
        F.log(words),
        F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_SIZE) / (words + PRIOR_WORDS)),
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / lines),
        F.sqrt(F.col("n_repeat_words") / words),
        F.log(words / lines),
        F.log1p(F.col("n_distinct")) / F.log1p(words),
    ]
    return [v.alias(f"v{i}") for i, v in enumerate(values)]


def chi2_quantile(p: int, tail: float) -> float:
    """Wilson and Hilferty's approximation."""
    z = NormalDist().inv_cdf(1 - tail)
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _distance() -> Column:
    """Squared Mahalanobis distance of v0.. from the centre array under the precision array."""
    dx = [F.col(f"v{i}") - F.col("centre")[i] for i in range(P)]
    terms = [F.col("precision")[k] * dx[i] * dx[j] for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _bin(d2: Column) -> Column:
    return F.floor(F.log(F.greatest(d2, F.lit(1e-9))) * BINS).cast("int")


_PARAMS = "grp string, start int, centre array<double>, precision array<double>, logdet double"


def _fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and precision of each row of sums (n, origin, s_i, s_ij)."""
    floor = np.diag(np.square(list(VECTOR.values())))
    for batch in batches:
        out = []
        for row in batch.to_dict("records"):
            mean = np.array([row[f"s{i}"] for i in range(P)]) / row["n"]
            cov = np.zeros((P, P))
            for k, (i, j) in enumerate(PAIRS):
                cov[i, j] = cov[j, i] = row[f"q{k}"] / row["n"] - mean[i] * mean[j]
            out.append((row["grp"], row["start"], np.array(row["origin"]) + mean, cov))
        yield _params(out, floor)


def _params(found: list[tuple], floor: np.ndarray) -> pd.DataFrame:
    rows = []
    for grp, start, centre, cov in found:
        cov = cov + floor
        inv = np.linalg.inv(cov)
        precision = [float(inv[i, j] * (1 if i == j else 2)) for i, j in PAIRS]
        rows.append((grp, start, [float(x) for x in centre], precision, float(np.linalg.slogdet(cov)[1])))
    return pd.DataFrame(rows, columns=["grp", "start", "centre", "precision", "logdet"])


def _from_quartiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    floor = np.diag(np.square(list(VECTOR.values())))
    for batch in batches:
        yield _params(
            [
                (r["grp"], 1, np.array(r["middle"]), np.diag(np.square((np.array(r["upper"]) - np.array(r["lower"])) / 1.349)))
                for r in batch.to_dict("records")
            ],
            floor,
        )


def _sums(rows: DataFrame) -> DataFrame:
    dx = [F.col(f"v{i}") - F.col("centre")[i] for i in range(P)]
    return rows.groupBy("grp", "start").agg(
        F.count(F.lit(1)).alias("n"),
        F.first("centre").alias("origin"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(dx)],
        *[F.sum(dx[i] * dx[j]).alias(f"q{k}") for k, (i, j) in enumerate(PAIRS)],
    )


def _cut(rows: DataFrame, by: list[str], value: str, share: float, name: str) -> DataFrame:
    """Per group the least bin below or in which ``share`` of its rows lie."""
    binned = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    run = binned.select(
        "*", F.sum("n").over(w).alias("total"),
        F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    )
    return run.where(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy(*by).agg(F.min(value).alias(name))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates of v0.. per ``grp``.

    Returns grp, centre, precision, and scale: what a squared distance is divided by, so that the
    median row of the group lies no farther than the chi-square law's median. All rows of a group count. Two starts
    (moments of all rows; medians and quartiles) are concentrated: rows are ranked by distance in
    bins of their logarithm, the nearest ``SHARE`` of them give the next centre and covariance,
    until no determinant shrinks; the start with the smaller one wins. Bin counts and sums are the
    only things that are shuffled or gathered.
    """
    zero = F.array(*[F.lit(0.0)] * P)
    plain = _sums(rows.select("*", F.lit(0).alias("start"), zero.alias("centre"))).mapInPandas(_fitted, _PARAMS)
    fine = 256
    long = rows.select("grp", F.posexplode(F.array(*[F.floor(F.col(f"v{i}") * fine).cast("int") for i in range(P)])).alias("dim", "bin"))
    thirds = None
    for name, share in (("lower", 0.25), ("middle", 0.5), ("upper", 0.75)):
        cut = _cut(long, ["grp", "dim"], "bin", share, name)
        thirds = cut if thirds is None else thirds.join(cut, ["grp", "dim"])
    ordered = thirds.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("dim", "lower", "middle", "upper"))).alias("d"))
    quartiles = ordered.select("grp", *[
        F.transform(F.col(f"d.{n}"), lambda x: (x + 0.5) / fine).alias(n) for n in ("lower", "middle", "upper")
    ])
    params = settle(plain.unionByName(quartiles.mapInPandas(_from_quartiles, _PARAMS)))
    for _ in range(MOST_STEPS):
        far = rows.join(params, "grp").select("*", _bin(_distance()).alias("bin"))
        cut = _cut(far, ["grp", "start"], "bin", SHARE, "cut")
        near = far.join(cut, ["grp", "start"]).where("bin <= cut")
        after = settle(_sums(near).mapInPandas(_fitted, _PARAMS))
        moved = after.join(params.select("grp", "start", F.col("logdet").alias("was")), ["grp", "start"])
        still = moved.where(F.abs(F.col("logdet") - F.col("was")) > STILL).isEmpty()
        params = after
        if still:
            break
    best = params.groupBy("grp").agg(F.min(F.struct("logdet", "start", "centre", "precision")).alias("p")).select(
        "grp", "p.centre", "p.precision"
    )
    far = rows.join(best, "grp").select("grp", _bin(_distance()).alias("bin"))
    middle = _cut(far, ["grp"], "bin", 0.5, "mid").select(
        "grp", F.greatest(F.lit(1.0), F.exp((F.col("mid") + 0.5) / BINS) / chi2_quantile(P, 0.5)).alias("scale")
    )
    return settle(best.join(middle, "grp"))


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    tail: float = TAIL,
    least_group: int = LEAST_GROUP,
) -> DataFrame:
    """Judges each document by fixed limits and by how far its statistics lie from its group's.

    Returns one row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance (squared, scaled; null if not compared), kept.

    Null and empty texts have no words and fail the base limits; they are not compared. A null
    language or source is a value of its own. Groups of under ``least_group`` rows (of those that
    pass the limits) are pooled by language, what is left then in one group, and a last group that
    is still too small rejects nothing. Repeated rows count as often as they occur and get the same
    verdict. Extra columns are ignored. An empty table gives an empty result.
    """
    named = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.concat(F.lit("="), F.col(f"`{lang_col}`").cast("string")).alias("g_lang"),
        F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")).alias("g_source"),
        F.col(f"`{text_col}`").alias("text"),
    ).fillna("", ["g_lang", "g_source"])
    counted = with_counts(named, "text", ("doc_id", "g_lang", "g_source"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    stats = settle(counted.select("*", failed.alias("base_failed"), *vector()))
    fit = stats.where("not base_failed").groupBy("g_lang", "g_source").agg(F.count(F.lit(1)).alias("n"))
    small = F.when(F.col("n") < least_group, F.col("n")).otherwise(0)
    pooled = fit.select("*", F.sum(small).over(Window.partitionBy("g_lang")).alias("rest"))
    groups = settle(pooled.select(
        "g_lang", "g_source",
        F.when(F.col("n") >= least_group, F.to_json(F.array("g_lang", "g_source")))
        .when(F.col("rest") >= least_group, F.to_json(F.array("g_lang")))
        .otherwise(F.lit("")).alias("grp"), "n",
    ))
    enough = settle(groups.groupBy("grp").agg(F.sum("n").alias("rows")).where(F.col("rows") >= least_group))
    groups = groups.join(enough, "grp").select("g_lang", "g_source", "grp")
    compared = stats.where("not base_failed").join(groups, ["g_lang", "g_source"])
    best = robust_estimates(settle(compared.select("grp", *[f"v{i}" for i in range(P)])))
    cutoff = chi2_quantile(P, tail)
    judged = (
        stats.join(groups, ["g_lang", "g_source"], "left")
        .join(best, "grp", "left")
        .select("*", F.when(~F.col("base_failed"), _distance() / F.col("scale")).alias("distance"))
    )
    return judged.select(
        "doc_id", *COUNTS, "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
    )


shipped(__name__)
