"""Tables in and out.

Parquet between stages; TSV/CSV/JSON only at the edges, as the reference uses.
Text feature values are read as STRING and converted with ``try_cast`` so that
``inf``, ``NaN``, blanks and words behave as pandas would (see P2/P4).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from motifspark.operators.features import clean_features, coerce_numeric, require_columns


def _num(c: str):
    """String -> double the way pandas reads numbers: inf/-inf/nan words, blanks -> NULL."""
    s = F.lower(F.trim(F.col(c)))
    return (F.when(s.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
             .when(s.isin("-inf", "-infinity"), F.lit(float("-inf")))
             .when(s.isin("nan", "na", "n/a", "null", ""), F.lit(None).cast("double"))
             .otherwise(F.col(c).try_cast("double")))


def read_features(spark: SparkSession, path, sep: str = "\t", name_col: str = "NAME") -> DataFrame:
    """Wide text feature table, first column the name; every other column to DOUBLE."""
    raw = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    first = raw.columns[0]
    keep = {name_col, "idr_name", "CLASS"}
    cols = [F.col(first).alias(name_col) if first != name_col else F.col(name_col)]
    for c in raw.columns[1:]:
        if c in keep:
            cols.append(F.col(c).cast("int").alias(c) if c == "CLASS" else F.col(c))
        else:
            cols.append(_num(c).alias(c))
    return raw.select(*cols)


def read_labelled(spark: SparkSession, path, sep: str = ",", drop=("idr_name",), expected: int | None = None) -> DataFrame:
    """Labelled table: needs CLASS; drops idr_name and a drop list; cleans features."""
    df = read_features(spark, path, sep=sep, name_col="NAME")
    require_columns(df, "CLASS")
    df = df.drop(*drop)
    feats = [c for c in df.columns if c not in ("NAME", "CLASS")]
    if expected is not None and len(feats) != expected:
        raise ValueError(f"expected {expected} feature columns, found {len(feats)}")
    return clean_features(df, feats)


def read_scoring(spark: SparkSession, path, sep: str = "\t", drop=("idr_name", "CLASS")) -> DataFrame:
    """Scoring table: needs NAME; drops idr_name and CLASS; cleans features."""
    df = read_features(spark, path, sep=sep)
    require_columns(df, "NAME")
    df = df.drop(*drop)
    return clean_features(df, [c for c in df.columns if c != "NAME"])


def read_ids(spark: SparkSession, path, missing_ok: bool = False) -> DataFrame:
    """One ID per line, trimmed, blanks skipped, deduplicated; a missing file is empty when allowed."""
    try:
        df = spark.read.text(path)
    except AnalysisException as e:
        if not (missing_ok and "PATH_NOT_FOUND" in str(e)):
            raise
        return spark.createDataFrame([], "id string")
    return df.select(F.trim("value").alias("id")).where(F.length("id") > 0).distinct()


def read_prediction_lists(spark: SparkSession, root: str, glob: str = "*.txt", include: str = "", folders: bool = False) -> DataFrame:
    """All lists under ``root`` (recursive, by glob), ``list_id`` = file path; optional substring filter.

    An error when no file matches; an empty file is a list without names. With ``folders`` the folder is the list, as
    ``write_prediction_lists`` leaves it, and ``list_id`` its path.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    if not any(include in f for f in raw.inputFiles()):
        raise FileNotFoundError(f"no file under {root} matches {glob}" + (f" and holds {include}" if include else ""))
    df = raw.select(F.col("_metadata.file_path").alias("list_id"), F.trim("value").alias("name"))
    if folders:
        df = df.withColumn("list_id", F.regexp_replace("list_id", "/[^/]*$", ""))
    if include:
        df = df.where(F.col("list_id").contains(include))
    return df


def read_regions(spark: SparkSession, path) -> DataFrame:
    """Region TSV by header names."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    require_columns(df, "seq_id", "start", "end", "n_frags")
    return df.select("seq_id", F.col("start").cast("int"), F.col("end").cast("int"), F.col("n_frags").cast("bigint"))


def read_importance(spark: SparkSession, path) -> DataFrame:
    """Importance CSV with a column check."""
    df = spark.read.option("header", True).csv(path)
    require_columns(df, "feature", "importance")
    return df.select("feature", F.col("importance").cast("double"),
                     *([F.col("cum_fraction").cast("double")] if "cum_fraction" in df.columns else []))


def read_json_list(spark: SparkSession, path: str) -> list:
    """A JSON drop list (a small configuration file), from wherever Spark can read."""
    return list(json.loads("".join(r[0] for r in spark.read.option("wholetext", True).text(path).limit(1).collect())))


SINGLE_ROWS = 1_000_000


def _single(df: DataFrame, single: bool) -> DataFrame:
    if single and df.limit(SINGLE_ROWS + 1).count() > SINGLE_ROWS:
        raise ValueError(f"more than {SINGLE_ROWS} rows do not go into one file")
    return df.coalesce(1) if single else df


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", single: bool = False) -> None:
    """K3: TSV with header (``single`` for a small table that must be one file, at most ``SINGLE_ROWS`` rows)."""
    _single(df, single).write.mode(mode).option("header", True).option("sep", "\t").csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single: bool = False) -> None:
    """K4: CSV with header."""
    _single(df, single).write.mode(mode).option("header", True).csv(path)


def write_predictions(pairs: DataFrame, path: str, keys=("family", "crit", "tag", "mult", "n_feats", "model"),
                      mode: str = "overwrite") -> None:
    """K5: prediction lists, one folder per model identity (partition pruning replaces path parsing)."""
    pairs.sortWithinPartitions(*keys, "name").write.mode(mode).partitionBy(*keys).parquet(path)


def write_consensus(cons: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7: consensus lists, one folder per threshold; its files, in order, are one sorted list."""
    cons.select("pct", "name").repartitionByRange("pct", "name").sortWithinPartitions("pct", "name") \
        .write.mode(mode).partitionBy("pct").text(path)


CACHE_KEYS = ["family", "crit", "tag", "mult", "n_feats", "model"]


def write_params(params: DataFrame, path: str) -> None:
    """Searched parameters ``(*CACHE_KEYS, params, score)`` as JSON lines. Each call is a commit in a folder of its own, stamped when it
    starts; a redone search wins by its stamp. Searches may write at the same time: none touches the files of another."""
    commit = uuid.uuid4().hex
    rows = params.select(*CACHE_KEYS, "params", "score", F.unix_micros(F.current_timestamp()).alias("saved"), F.lit(commit).alias("commit"))
    rows.write.json(f"{path.rstrip('/')}/commit-{commit}")


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """The cache, newest entry per key; empty where nothing was saved yet.

    Commits of one microsecond are ordered by their ids, entries of one key in one commit by score, then parameters: every
    reader sees the same winner. ``commit`` is the winner's; it is null for entries saved without one.
    """
    schema = "family string, crit string, tag string, mult int, n_feats int, model string, params string, score double, saved long, commit string"
    try:
        df = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    newest = F.max_by(F.struct("params", "score", "commit"), F.struct("saved", "commit", "score", "params"))
    return df.groupBy(*CACHE_KEYS).agg(newest.alias("p")).select(*CACHE_KEYS, "p.*")


def write_models(models: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: the coefficient table ``(list_id, weights, bias)``; it is all that scoring needs of a linear model."""
    models.select("list_id", "weights", "bias").write.mode(mode).parquet(path)


def read_models(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """K8: a coefficient table; with ``required=False`` a missing one is empty."""
    schema = "list_id string, weights array<double>, bias double"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if required or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_mlps(mlps: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: the table of perceptrons that ``train.mlp_table`` makes."""
    from motifspark.operators.train import MLP_SCHEMA
    mlps.select(*[c.split()[0] for c in MLP_SCHEMA.split(", ")]).write.mode(mode).parquet(path)


def read_mlps(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """K8: a table of perceptrons; with ``required=False`` a missing one is empty."""
    from motifspark.operators.train import MLP_SCHEMA
    try:
        return spark.read.schema(MLP_SCHEMA).parquet(path)
    except AnalysisException as e:
        if required or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MLP_SCHEMA)


def write_prediction_lists(pairs: DataFrame, path: str, keys=("family", "crit", "tag", "mult", "n_feats", "model"), mode: str = "overwrite") -> None:
    """K5 as text that ``read_prediction_lists`` reads: one folder per model identity, one name a line, sorted within a file.

    Spark writes a list in as many ``.txt`` files as tasks hold a share of it; the folder is the list.
    """
    keys = list(keys)
    pairs.select(*keys, "name").repartitionByRange(*keys, "name").sortWithinPartitions(*keys, "name").write.mode(mode).partitionBy(*keys).text(path)


def coerce_table(df: DataFrame, keep=("NAME",)) -> DataFrame:
    """P4 over a whole table read as text."""
    return coerce_numeric(df, [c for c in df.columns if c not in set(keep)])
