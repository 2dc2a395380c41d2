"""Classifier evaluation from (label, score) tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.expressions import half_even
from shoplens.functions.ranking import running_totals


def _ratio(part: Column, whole: Column) -> Column:
    """Zero when nothing was predicted or present."""
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _cells(scored: DataFrame, label: str, probability: str, threshold: float) -> DataFrame:
    """True/false positives and negatives in one row."""
    truth = F.col(label) == 1
    called = F.col(probability) > threshold
    return scored.agg(
        F.count_if(~truth & ~called).alias("TN"),
        F.count_if(~truth & called).alias("FP"),
        F.count_if(truth & ~called).alias("FN"),
        F.count_if(truth & called).alias("TP"),
    )


def confusion_matrix(
    scored: DataFrame, label: str, probability: str, threshold: float = 0.5
) -> DataFrame:
    """Four rows: truth, prediction, customers; empty cells are 0."""
    cells = F.array(
        *[
            F.struct(
                F.lit(truth).alias("Truth"),
                F.lit(called).alias("Prediction"),
                F.col(cell).alias("Customers"),
            )
            for truth, called, cell in ((0, 0, "TN"), (0, 1, "FP"), (1, 0, "FN"), (1, 1, "TP"))
        ]
    )
    return _cells(scored, label, probability, threshold).select(F.inline(cells))


def classification_metrics(
    scored: DataFrame, label: str, probability: str, threshold: float = 0.5, places: int = 4
) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC-AUC of the positive class, rounded."""
    tp, fp, fn, tn = (F.col(c) for c in ("TP", "FP", "FN", "TN"))
    auc = roc_auc(scored, label, probability).scalar()
    return _cells(scored, label, probability, threshold).select(
        half_even(_ratio(tp + tn, tp + tn + fp + fn), places).alias("Accuracy"),
        half_even(_ratio(tp, tp + fp), places).alias("Precision"),
        half_even(_ratio(tp, tp + fn), places).alias("Recall"),
        half_even(_ratio(2 * tp, 2 * tp + fp + fn), places).alias("F1"),
        half_even(auc, places).alias("ROC-AUC"),
    )


def classification_report(
    scored: DataFrame,
    label: str,
    probability: str,
    threshold: float = 0.5,
    names: tuple[str, str] = ("Active", "Churned"),
) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("TP", "FP", "FN", "TN"))
    per_class = _cells(scored, label, probability, threshold).select(
        _ratio(tn, tn + fn).alias("p0"),
        _ratio(tn, tn + fp).alias("r0"),
        _ratio(2 * tn, 2 * tn + fp + fn).alias("f0"),
        (tn + fp).alias("n0"),
        _ratio(tp, tp + fp).alias("p1"),
        _ratio(tp, tp + fn).alias("r1"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("n1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("acc"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    rows = n0 + n1

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("Class"),
            precision.alias("Precision"),
            recall.alias("Recall"),
            f1.alias("F1"),
            support.alias("Support"),
        )

    def mean(letter):
        return (F.col(f"{letter}0") + F.col(f"{letter}1")) / 2

    def weighted(letter):
        return _ratio(F.col(f"{letter}0") * n0 + F.col(f"{letter}1") * n1, rows.cast("double"))

    accuracy = F.col("acc")
    return per_class.select(
        F.inline(
            F.array(
                line(names[0], F.col("p0"), F.col("r0"), F.col("f0"), n0),
                line(names[1], F.col("p1"), F.col("r1"), F.col("f1"), n1),
                line("accuracy", accuracy, accuracy, accuracy, rows),
                line("macro avg", mean("p"), mean("r"), mean("f"), rows),
                line("weighted avg", weighted("p"), weighted("r"), weighted("f"), rows),
            )
        )
    )


def _by_score(scored: DataFrame, label: str, probability: str) -> DataFrame:
    """Positives and negatives per distinct score: ties fold before anything is sorted."""
    return scored.groupBy(F.col(probability).cast("double").alias("Score")).agg(
        F.count_if(F.col(label) == 1).alias("Pos"), F.count_if(F.col(label) != 1).alias("Neg")
    )


def roc_auc(
    scored: DataFrame, label: str, probability: str, partitions: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null when a class is missing."""
    steps = running_totals(
        _by_score(scored, label, probability), [F.col("Score")], {"NegUpTo": "Neg"}, partitions
    )
    # Twice the pairs ranked right, kept in exact integers.
    twice = F.col("Pos").cast("decimal(20,0)") * (2 * F.col("NegUpTo") - F.col("Neg"))
    pairs = F.sum("Pos").cast("double") * F.sum("Neg").cast("double")
    return steps.agg(
        (F.sum(twice).cast("double") / 2 / F.nullif(pairs, F.lit(0.0))).alias("RocAuc")
    )


def roc_curve(
    scored: DataFrame, label: str, probability: str, partitions: int | None = None
) -> DataFrame:
    """Curve points by falling threshold, the origin first, collinear points left out.

    A point between two equal steps is collinear, so each step is compared with the next one by
    an equi-join on its global position.
    """
    steps = running_totals(
        _by_score(scored, label, probability).withColumn("One", F.lit(1)),
        [F.desc("Score")],
        {"TruePos": "Pos", "FalsePos": "Neg", "Step": "One"},
        partitions,
    )
    following = steps.select(
        (F.col("Step") - 1).alias("Step"), F.col("Pos").alias("_pos"), F.col("Neg").alias("_neg")
    )
    totals = steps.agg(
        F.struct(F.sum("Pos").cast("double").alias("p"), F.sum("Neg").cast("double").alias("n"))
    ).scalar()
    bends = (
        (F.col("Step") == 1)
        | F.col("_pos").isNull()
        | (F.col("Pos") != F.col("_pos"))
        | (F.col("Neg") != F.col("_neg"))
    )
    points = steps.join(following, "Step", "left").filter(bends)
    curve = points.select(
        (F.col("FalsePos") / F.nullif(totals.getField("n"), F.lit(0.0))).alias("Fpr"),
        (F.col("TruePos") / F.nullif(totals.getField("p"), F.lit(0.0))).alias("Tpr"),
        F.col("Score").alias("Threshold"),
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(0.0).alias("Fpr"), F.lit(0.0).alias("Tpr"), F.lit(float("inf")).alias("Threshold")
    )
    return origin.unionByName(curve)
