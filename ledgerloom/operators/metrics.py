"""Model evaluation in original units, as aggregates over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import finite, share
from ledgerloom.functions.ordering import exact_quantiles, running_totals

LOWEST_THRESHOLD, HIGHEST_THRESHOLD = 5, 95  # percent, in steps of one


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def confusion_counts(y: Column, flagged: Column) -> list[Column]:
    """tn, fp, fn, tp."""
    return [
        F.count_if((y == 0) & ~flagged).alias("tn"),
        F.count_if((y == 0) & flagged).alias("fp"),
        F.count_if((y == 1) & ~flagged).alias("fn"),
        F.count_if((y == 1) & flagged).alias("tp"),
    ]


def _rates() -> list[Column]:
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    return [
        ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
        _or_zero(share(tp, tp + fp)).alias("precision"),
        _or_zero(share(tp, tp + fn)).alias("recall"),
        _or_zero(share(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    ]


def confusion_matrix(scored: DataFrame, y: str, p: str, threshold: Column) -> DataFrame:
    """Long form; all four cells are present even when empty."""
    counts = scored.agg(*confusion_counts(F.col(y), F.col(p) >= threshold))
    return counts.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, customers)")


def classification_metrics(scored: DataFrame, y: str, p: str, threshold: Column) -> DataFrame:
    """Accuracy, precision, recall and F1 at ``p >= threshold``; undefined rates are zero."""
    counts = scored.agg(*confusion_counts(F.col(y), F.col(p) >= threshold))
    return counts.select("tn", "fp", "fn", "tp", *_rates())


def roc_auc(scored: DataFrame, y: str, p: str) -> DataFrame:
    """Exact AUC: ties count half. Equal scores collapse first; prefix counts are built bucket by bucket."""
    counts = scored.groupBy(p).agg(
        F.count_if(F.col(y) == 1).alias("pos"),
        F.count_if(F.col(y) == 0).alias("neg"),
    )
    ranked = running_totals(counts, p, ["pos", "neg"])
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return ranked.agg(share(wins, pairs).alias("roc_auc"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def threshold_table(scored: DataFrame, y: str, p: str) -> DataFrame:
    """Confusion counts and rates for the 91 thresholds .05, .06, ... .95.

    Each row is counted once, under the highest threshold it meets; the counts above a threshold are then
    sums over at most 101 rows.
    """
    guess = F.floor(F.col(p) * 100)
    step = (
        F.when((guess + 1) / 100.0 <= F.col(p), guess + 1)
        .when(guess / 100.0 > F.col(p), guess - 1)
        .otherwise(guess)
    )
    met = (
        scored.withColumn("step", F.least(step, F.lit(HIGHEST_THRESHOLD)))
        .groupBy("step")
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    )
    grid = F.sequence(F.lit(LOWEST_THRESHOLD), F.lit(HIGHEST_THRESHOLD))
    flagged = F.col("step") >= F.col("cut")
    return (
        met.withColumn("cut", F.explode(grid))
        .groupBy("cut")
        .agg(
            F.sum(F.when(~flagged, F.col("neg")).otherwise(0)).alias("tn"),
            F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(~flagged, F.col("pos")).otherwise(0)).alias("fn"),
            F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
        )
        .select((F.col("cut") / 100.0).alias("threshold"), "tn", "fp", "fn", "tp", *_rates())
    )


def choose_threshold(scored: DataFrame, y: str, p: str, minimum_recall: float) -> DataFrame:
    """Best F1 among thresholds that reach the recall; ties go to the highest, none gives zero."""
    table = threshold_table(scored, y, p).filter(F.col("recall") >= minimum_recall)
    return table.agg(
        F.coalesce(F.max_by("threshold", F.struct("f1", "threshold")), F.lit(0.0)).alias("threshold"),
        F.max("f1").alias("f1"),
    )


def error_rows(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Signed (predicted - actual), absolute and squared errors per row."""
    error = F.col("predicted") - F.col("actual")
    return (
        df.withColumns({"actual": F.col(actual).cast("double"), "predicted": F.col(predicted).cast("double")})
        .withColumn("error", error)
        .withColumns({"absolute_error": F.abs("error"), "squared_error": F.col("error") * F.col("error")})
    )


def check_errors(rows: DataFrame) -> DataFrame:
    """Raise for empty input or non-finite values."""
    found = rows.agg(
        F.count("*").alias("rows"), F.count_if(~finite(F.col("actual")) | ~finite(F.col("predicted"))).alias("bad")
    ).first()
    if not found.rows:
        raise ValueError("Actual and predicted must not be empty")
    if found.bad:
        raise ValueError("Evaluation values must be finite")
    return rows


def _regression_columns() -> list[Column]:
    mse = F.avg("squared_error")
    spread = F.sum("squared_error") / F.nullif(F.var_pop("actual") * F.count("*"), F.lit(0.0))
    # A constant target leaves R2 at one for a perfect fit and zero otherwise.
    constant = F.when(F.sum("squared_error") == 0, 1.0).otherwise(0.0)
    return [
        F.avg("absolute_error").alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.coalesce(1 - spread, constant).alias("r2"),
    ]


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, MSE, RMSE and R2 in one pass."""
    return error_rows(df, actual, predicted).agg(*_regression_columns())


def error_summary(rows: DataFrame, worst: int = 10) -> DataFrame:
    """Regression metrics plus median absolute error, bias and the weight of the worst errors."""
    median = exact_quantiles(rows, ["absolute_error"], [0.5]).select("value").scalar()
    top = rows.orderBy(F.desc("squared_error")).limit(worst).agg(F.sum("squared_error").alias("s")).scalar()
    summary = rows.agg(
        *_regression_columns(),
        F.avg("error").alias("mean_error"),
        F.sum("squared_error").alias("total"),
        F.count("*").alias("count"),
    )
    return summary.select(
        "mae",
        "mse",
        "rmse",
        "r2",
        median.alias("median_absolute_error"),
        "mean_error",
        _or_zero(share(top, F.col("total"))).alias(f"worst_{worst}_squared_error_share"),
        "count",
    )


def macro_f1(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and unweighted mean F1 over every label that was observed or predicted.

    Rows collapse to one per (actual, predicted) pair before labels are counted from both sides.
    """
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("b")).agg(F.count("*").alias("n"))
    sides = pairs.select(
        "n",
        (F.col("a") == F.col("b")).alias("hit"),
        F.explode(
            F.array(
                F.struct(F.col("a").alias("label"), F.lit("actual").alias("side")),
                F.struct(F.col("b").alias("label"), F.lit("predicted").alias("side")),
            )
        ).alias("seen"),
    )
    per_label = sides.groupBy("seen.label").agg(
        F.sum(F.when(F.col("hit") & (F.col("seen.side") == "actual"), F.col("n")).otherwise(0)).alias("hits"),
        F.sum("n").alias("mentions"),
        F.sum(F.when(F.col("seen.side") == "actual", F.col("n")).otherwise(0)).alias("rows"),
    )
    return per_label.agg(
        share(F.sum("hits"), F.sum("rows")).alias("accuracy"),
        F.avg(2.0 * F.col("hits") / F.col("mentions")).alias("macro_f1"),
    )


def churn_mistakes(scored: DataFrame, y: str, p: str, threshold: Column) -> DataFrame:
    """Error rate and the two kinds of mistake."""
    counts = scored.agg(*confusion_counts(F.col(y), F.col(p) >= threshold))
    wrong = F.col("fp") + F.col("fn")
    right = F.col("tn") + F.col("tp")
    return counts.select(
        share(wrong, wrong + right).alias("error_rate"),
        wrong.alias("incorrect"),
        right.alias("correct"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
    )


def largest_errors(rows: DataFrame, limit: int = 15) -> DataFrame:
    """Rows with the largest absolute error."""
    return rows.orderBy(F.desc("absolute_error"), "customer_id").limit(limit)


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that carries how often the key occurs on either side.

    Repeats are counted per side, so a duplicated key stays two rows instead of multiplying.
    """
    counts = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return counts.groupBy(key).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))


def check_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join; raises where a key repeats on either side."""
    repeated = one_to_one(left, right, key).filter((F.col("left_rows") > 1) | (F.col("right_rows") > 1))
    if repeated.limit(1).count():
        raise ValueError(f"{key} must be unique on both sides of the join")
    return left.join(right, key)
