"""Feature ranking and selection.

The importance table has one row per feature (a few hundred at most), so the
running share is an un-partitioned window: its size is bounded by the feature
count, never by the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from motifspark.operators.extratrees import importances


def feature_importance(df: DataFrame, feature_cols: list[str], label_col: str = "CLASS", n_trees: int = 500, seed: int = 0) -> DataFrame:
    """Impurity importances of extremely randomised trees -> ``(feature, importance)`` (sum to 1)."""
    imp = importances(df, feature_cols, label_col, n_trees, seed)
    return df.sparkSession.createDataFrame([(f, float(v)) for f, v in zip(feature_cols, imp)], "feature string, importance double")


def cum_importance(imp: DataFrame) -> DataFrame:
    """Sort by importance desc (then name), ``cum_fraction`` = running sum / total
    (divisor 1 when the total is 0), ``pos`` = 1-based rank."""
    order = Window.orderBy(F.desc("importance"), F.asc("feature"))
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("importance").over(Window.partitionBy())
    denom = F.when(total == 0, F.lit(1.0)).otherwise(total)
    return imp.select("feature", "importance",
                      (F.sum("importance").over(run) / denom).alias("cum_fraction"),
                      F.row_number().over(order).alias("pos"))


def set_name(t: float) -> str:
    """X11: ``cum<int(t*100)>`` (truncates, as ``int`` does: 0.29 -> 28)."""
    return f"cum{int(t * 100)}"


def bucket_suffix(m: int) -> str:
    """X11: empty for the 1x bucket, the multiple otherwise."""
    return "" if int(m) == 1 else str(int(m))


def set_name_of(t: Column) -> Column:
    """X11 over a column of thresholds."""
    return F.concat(F.lit("cum"), (t * 100).cast("int").cast("string"))


def bucket_suffix_of(m: Column) -> Column:
    """X11 over a column of multiples."""
    return F.when(m == 1, F.lit("")).otherwise(m.cast("string"))


def feature_select(cum: DataFrame, thresholds=(0.90, 0.95)) -> DataFrame:
    """For each t keep features with cum_fraction <= t plus the first one crossing t.

    A feature is kept when the share *before* it is <= t (the first feature always).
    -> ``(set_name, threshold, pos, feature)``.
    """
    order = Window.orderBy("pos")
    prev = F.coalesce(F.lag("cum_fraction").over(order), F.lit(0.0))
    x = cum.select("pos", "feature", "cum_fraction", prev.alias("prev"))
    out = None
    for t in thresholds:
        s = x.where((F.col("prev") <= F.lit(float(t))) | (F.col("pos") == 1)) \
             .select(F.lit(set_name(t)).alias("set_name"), F.lit(float(t)).alias("threshold"), "pos", "feature")
        out = s if out is None else out.unionByName(s)
    return out


def derive_drop_list(all_features: DataFrame, selected: DataFrame, thresholds=(0.90, 0.95)) -> DataFrame:
    """Per feature set, the features not selected -> ``(set_name, feature)`` (one anti join per set)."""
    out = None
    for t in thresholds:
        name = set_name(t)
        keep = selected.where(F.col("set_name") == name).select("feature")
        d = all_features.select("feature").join(keep, "feature", "left_anti") \
                        .select(F.lit(name).alias("set_name"), "feature")
        out = d if out is None else out.unionByName(d)
    return out
