"""Exact classification metrics as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions.numeric import harmonic_f1
from hitloom.operators.ranking import RANGE_ROWS, class_cells, rank_statistics, ranges_for
from hitloom.operators.skew import running_sums
from hitloom.session import settle


def _cell(label: str, predicted: str, y: int, p: int) -> Column:
    return F.count_if((F.col(label) == y) & (F.col(predicted) == p))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "is_hit", predicted: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    names = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return df.agg(*[_cell(label, predicted, y, p).alias(n) for n, (y, p) in names.items()])


def confusion_cells(df: DataFrame, label: str = "is_hit", predicted: str = "prediction") -> DataFrame:
    """The full 2x2 grid in long form, empty cells included."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    grid = F.array(
        *[F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(n).alias("n")) for n, y, p in cells]
    )
    return confusion_counts(df, label, predicted).select(F.inline(grid))


def binary_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 from tn, fp, fn, tp; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tn + tp, tn + fp + fn + tp),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, fn + tp
    n = n0 + n1
    zero = (_ratio(tn, tn + fn), _ratio(tn, n0), _ratio(2 * tn, 2 * tn + fp + fn))
    one = (_ratio(tp, tp + fp), _ratio(tp, n1), _ratio(2 * tp, 2 * tp + fp + fn))
    acc = _ratio(tn + tp, n)
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [_ratio(a * n0 + b * n1, n) for a, b in zip(zero, one)]

    def line(name: str, values, support: Column) -> Column:
        p, r, f = values
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), support.alias("support")
        )

    return counts.select(
        F.inline(
            F.array(
                line("0", zero, n0),
                line("1", one, n1),
                line("accuracy", (acc, acc, acc), n),
                line("macro avg", macro, n),
                line("weighted avg", weighted, n),
            )
        )
    )


def roc_auc(df: DataFrame, score: str, label: str = "is_hit", rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Exact area under the ROC curve; NULL unless both classes occur."""
    stats = rank_statistics(df, [score], label, rows_per_range)
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return stats.select("n_pos", "n_neg", F.when(both, F.col("auc")).alias("roc_auc"))


def threshold_curve(df: DataFrame, score: str, label: str = "is_hit", rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Precision, recall and F1 when rows scoring at least a distinct score count as hits."""
    cells = settle(class_cells(df, [score], label))
    sums = {"pos": "pos_above", "neg": "neg_above"}
    above = running_sums(cells, "value", sums, ranges_for(cells, rows_per_range), descending=True)
    hits = cells.agg(F.sum("pos").alias("p")).scalar()
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, hits)
    return above.select(
        F.col("value").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        precision.alias("precision"),
        recall.alias("recall"),
        harmonic_f1(precision, recall).alias("f1"),
    )


def best_threshold(df: DataFrame, score: str, label: str = "is_hit", rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """The threshold with the highest F1, the lowest such one; 0.5 unless both classes occur."""
    curve = threshold_curve(df, score, label, rows_per_range)
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("neg")))
    summary = curve.agg(best.alias("best"), F.max("tp").alias("pos"), F.max("fp").alias("neg"))
    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    return summary.select(
        F.when(both, -F.col("best.neg")).otherwise(F.lit(0.5)).alias("threshold"),
        F.when(both, F.col("best.f1")).alias("f1"),
    )
