"""Feature tables: composition featurizer (X9), cleaning (P1-P4), checks (P5, P6),
assembly (P7) and feature-set projection (P15).

Wide tables are transformed with ONE ``select`` over all columns (never a
``withColumn`` loop), so the plan stays a single projection inside codegen and
column pruning still reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from motifspark.functions.text import RESIDUES

KEY_COLS = ("NAME", "CLASS", "idr_name")


def composition_features(windows: DataFrame, residues: str = RESIDUES, name_col: str = "name",
                         keep: tuple = ()) -> DataFrame:
    """Fraction of each residue letter in ``sub`` -> ``NAME, *keep, f_A .. f_Y``."""
    sub = F.col("sub")
    n = F.length(sub).cast("double")
    feats = [((F.length(sub) - F.length(F.replace(sub, F.lit(a), F.lit("")))) / n).alias(f"f_{a}") for a in residues]
    return windows.select(F.col(name_col).alias("NAME"), *keep, *feats)


def composition_names(residues: str = RESIDUES) -> list[str]:
    return [f"f_{a}" for a in residues]


def feature_columns(df: DataFrame, exclude=KEY_COLS) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail before any job when a required column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {missing}")


def assert_feature_count(cols: list[str], expected: int | None) -> None:
    """P5: the number of feature columns must equal the model's width."""
    if expected is not None and len(cols) != expected:
        raise ValueError(f"expected {expected} feature columns, found {len(cols)}")


def fill_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL and NaN -> 0; +-inf are kept."""
    cols = cols if cols is not None else feature_columns(df)
    s = set(cols)
    return df.select(*[F.when(F.col(c).isNull() | F.isnan(c), F.lit(0.0)).otherwise(F.col(c)).alias(c)
                       if c in s else F.col(c) for c in df.columns])


def clean_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL, NaN, +inf and -inf -> 0."""
    cols = cols if cols is not None else feature_columns(df)
    s = set(cols)
    inf = float("inf")

    def fix(c):
        x = F.col(c)
        return F.when(x.isNull() | F.isnan(x) | (x == F.lit(inf)) | (x == F.lit(-inf)), F.lit(0.0)).otherwise(x)
    return df.select(*[fix(c).alias(c) if c in s else F.col(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Anything that is not a number becomes 0 (``try_cast``; ANSI ``cast`` would throw)."""
    cols = cols if cols is not None else feature_columns(df)
    s = set(cols)
    return df.select(*[F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)).alias(c)
                       if c in s else F.col(c) for c in df.columns])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop columns, ignoring names that are not there."""
    return df.drop(*[c for c in cols])


def project_feature_set(df: DataFrame, features: list[str], keep=("NAME",)) -> DataFrame:
    """Keep only the chosen features (column pruning reaches the scan)."""
    return df.select(*[k for k in keep if k in df.columns], *features)


def assemble(df: DataFrame, feature_cols: list[str], label_col: str | None = "CLASS",
             out: str = "features", expected: int | None = None, as_vector: bool = True) -> DataFrame:
    """Pack feature columns into one float vector (+ integer label)."""
    assert_feature_count(feature_cols, expected)
    arr = F.array(*[F.col(c).cast("double") for c in feature_cols])
    if as_vector:
        from pyspark.ml.functions import array_to_vector
        arr = array_to_vector(arr)
    keep = [c for c in ("NAME",) if c in df.columns]
    cols = [*keep, arr.alias(out)]
    if label_col:
        cols.append(F.col(label_col).cast("int").alias("label"))
    return df.select(*cols)
