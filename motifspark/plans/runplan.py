"""Run dimensions of one default pipeline run (J6) and the model identities they produce.

The dimensions are configuration, not data: a few dozen combinations, built on
the driver and handed to Spark as a small DataFrame.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

# Run dimensions of the default pipeline.
CRITERIA = ["f1", "max_recall", "fbeta"]
TAGS = ["PTM", "Random"]
MULTS = [1, 2, 5, 10]
FEATURE_SETS = [69, 126]
LINEAR_MODELS = ["sgd", "logreg", "sgd_partial"]
RESAMPLED_MODELS = ["sgd", "logreg", "sgd_partial"]
THRESHOLDS = [100, 95, 90, 85]


@dataclass(frozen=True)
class RunDims:
    criteria: list = field(default_factory=lambda: list(CRITERIA))
    tags: list = field(default_factory=lambda: list(TAGS))
    mults: list = field(default_factory=lambda: list(MULTS))
    feature_sets: list = field(default_factory=lambda: list(FEATURE_SETS))


def model_ids(dims: RunDims = RunDims()) -> list[dict]:
    """All model identities of one run: linear crit x tag x mult x feats x 3,
    MLP tag x mult x feats, resampled tag x feats x 3 (172 with the defaults)."""
    rows = []
    for crit, tag, m, f, mdl in itertools.product(dims.criteria, dims.tags, dims.mults, dims.feature_sets, LINEAR_MODELS):
        rows.append(dict(family="linear", crit=crit, tag=tag, mult=m, n_feats=f, model=mdl))
    for tag, m, f in itertools.product(dims.tags, dims.mults, dims.feature_sets):
        rows.append(dict(family="nn", crit="f1", tag=tag, mult=m, n_feats=f, model="mlp"))
    for tag, f, mdl in itertools.product(dims.tags, dims.feature_sets, RESAMPLED_MODELS):
        rows.append(dict(family="smoteenn", crit="f1", tag=tag, mult=0, n_feats=f, model=mdl))
    for r in rows:
        r["list_id"] = list_id(r)
    return rows


def list_id(r: dict) -> str:
    if r["family"] == "linear":
        return f"linear/{r['crit']}/{r['tag']}/{r['mult']}x/feats{r['n_feats']}/{r['model']}"
    if r["family"] == "nn":
        return f"nn/{r['tag']}/{r['mult']}x/feats{r['n_feats']}/{r['model']}"
    return f"smoteenn/{r['tag']}/feats{r['n_feats']}/{r['model']}"


def run_plan(spark, dims: RunDims = RunDims(), family: str | None = None):
    """The plan table (one row per model to train / list to predict)."""
    rows = [r for r in model_ids(dims) if family is None or r["family"] == family]
    schema = "family string, crit string, tag string, mult int, n_feats int, model string, list_id string"
    return spark.createDataFrame([tuple(r[c] for c in ["family", "crit", "tag", "mult", "n_feats", "model", "list_id"])
                                  for r in rows], schema)
