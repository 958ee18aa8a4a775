"""End-to-end flow (F8) and its stages F2-F4, L14, L15, L18, S12.

``run(spark, cfg, positives, reference, ids)`` chains the operators: windows (F1) -> features (X9, or ingested tables,
S12) -> control pools (F2) -> labelled tables per (tag, mult) (F3) -> importance and feature sets (F4) -> searched
(L11-L13, through the cache) or default parameters -> models of all families (L14/L15) -> one-pass scoring of every
reference window by every model (J8) -> consensus at all thresholds (F5) -> regions (F6) -> FASTA records (F7).
Each stage is a DataFrame; what reaches the driver is model coefficients, scaling statistics and counts.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from motifspark.functions.text import RESIDUES
from motifspark.operators import controls as CO
from motifspark.operators import sampling as SA
from motifspark.operators import search as SE
from motifspark.operators import tablefits as TF
from motifspark.operators import train as TR
from motifspark.operators.consensus import NoLists, consensus
from motifspark.operators.features import clean_features, composition_names, feature_columns, require_columns
from motifspark.operators.importance import cum_importance, feature_importance, feature_select, set_name
from motifspark.operators.knn import smote_enn
from motifspark.operators.predict import Models, WindowScores, composition_near, composition_rows, dedupe_support, n_lists_of, score_features
from motifspark.operators.windows import window_counts
from motifspark.plans import flows
from motifspark.plans.runplan import CRITERIA
from motifspark.session import materialise
from motifspark.sources.fasta import sequence_lookup
from motifspark.sources.tables import read_params, write_params

DEFAULT_PARAMS = {"logreg": {"C": 1.0}, "sgd": {"alpha": 1e-4, "penalty": "l2"}, "sgd_partial": {"alpha": 1e-4, "penalty": "l2"},
                  "mlp": {"hidden": [128, 64], "alpha": 1e-4, "learning_rate_init": 1e-3}, "resampler": {"smote_k": 5, "enn_k": 3}}
#: A pool of more than so many times its largest draw is not written before it is drawn from.
POOL_TIMES = 4
FAMILIES = ("linear", "nn", "smoteenn")


@dataclass
class PipelineConfig:
    window: int = 15
    step: int = 1
    min_len: int = 15
    tags: tuple = ("PTM", "Random")
    mults: tuple = (1, 2, 5, 10)
    random_control_n: int = 200_000
    seed: int = 0
    cum_thresholds: tuple = (0.90, 0.95)
    importance_trees: int = 500
    thresholds: tuple = (100, 95, 90, 85)
    min_frags: int = 2
    families: tuple = FAMILIES
    criteria: tuple = ("default",)          # with a cache: the searched criteria
    cache: str | None = None                # folder of the parameter cache; searches fill it, training reads it
    redo: bool = False
    mlp_iter: int = TR.MLP_ITER
    parallelism: int = 4                    # fits that run at the same time
    params: dict = field(default_factory=lambda: dict(DEFAULT_PARAMS))


# ---------------------------------------------------------------- features

def ingest_features(table: DataFrame, name_col: str = "NAME") -> DataFrame:
    """S12 ``use_res``: a precomputed feature table as it was read (S4), cleaned like the scoring table."""
    require_columns(table, name_col)
    return clean_features(table, [c for c in table.columns if c not in (name_col, "idr_name", "CLASS")])


def featurize(seqs: DataFrame, cfg: PipelineConfig, precomputed: DataFrame | None = None) -> DataFrame:
    """The precomputed table where there is one, else residue composition of every window."""
    if precomputed is not None:
        return ingest_features(precomputed)
    return composition_rows(seqs, RESIDUES, cfg.window, cfg.step, cfg.min_len).drop("seq_id", "start")


# ---------------------------------------------------------------- feature sets and parameters

def feature_sets(table: DataFrame, feature_cols: list[str], cfg: PipelineConfig) -> dict:
    """forest importances -> running share -> one feature list per cumulative threshold."""
    imp = feature_importance(table, feature_cols, n_trees=cfg.importance_trees, seed=cfg.seed)
    sel = feature_select(cum_importance(imp), cfg.cum_thresholds).collect()   # bounded by the feature count
    out = {}
    for r in sel:
        out.setdefault(r["set_name"], []).append((r["pos"], r["feature"]))
    return {k: [f for _, f in sorted(v)] for k, v in out.items()}


def _n(name: str) -> int:
    return int("".join(c for c in name if c.isdigit()) or 0)


def search_all(spark: SparkSession, tables: DataFrame, big: dict, sets: dict, cfg: PipelineConfig) -> None:
    """Search what the cache lacks (everything with ``redo``) and save the best of each criterion."""
    known = set() if cfg.redo else {(r["family"], r["tag"], r["mult"], r["n_feats"]) for r in read_params(spark, cfg.cache).select("family", "tag", "mult", "n_feats").distinct().collect()}
    for tag in cfg.tags:
        for sname, feats in sets.items():
            for m in cfg.mults:
                t = tables.where((F.col("tag") == tag) & (F.col("mult") == m))
                if "linear" in cfg.families and ("linear", tag, m, _n(sname)) not in known:
                    best = SE.best_per_model(SE.search_linear(t, feats, cfg.seed))
                    twin = best.where("model = 'sgd'").withColumn("model", F.lit("sgd_partial"))
                    _save(best.unionByName(twin), "linear", tag, m, sname, cfg)
                if "nn" in cfg.families and ("nn", tag, m, _n(sname)) not in known:
                    _save(SE.best_per_model(SE.search_mlp(t, feats, cfg.seed, max_iter=min(600, cfg.mlp_iter)), {"f1": "f1"}), "nn", tag, m, sname, cfg)
            if "smoteenn" in cfg.families and ("smoteenn", tag, 0, _n(sname)) not in known:
                found = SE.search_resampled(big[tag], feats, cfg.seed)
                # one order over (k_smote, k_enn, candidate); the resampler of a model travels with its parameters
                found = found.withColumn("grid_ord", F.col("grid_ord") + 1000 * F.dense_rank().over(_ks_order())).withColumn(
                    "params", F.to_json(F.struct("params", F.col("k_smote").alias("smote_k"), F.col("k_enn").alias("enn_k"))))
                best = SE.best_per_model(found, {"f1": "f1"})
                _save(best.unionByName(best.where("model = 'sgd'").withColumn("model", F.lit("sgd_partial"))), "smoteenn", tag, 0, sname, cfg)


def _ks_order():
    from pyspark.sql import Window
    return Window.orderBy("k_smote", "k_enn")   # a few dozen rows of one search


def _save(best: DataFrame, family: str, tag: str, mult: int, sname: str, cfg: PipelineConfig) -> None:
    write_params(best.select(F.lit(family).alias("family"), "crit", F.lit(tag).alias("tag"), F.lit(int(mult)).alias("mult"), F.lit(_n(sname)).alias("n_feats"),
                             "model", F.col("best").alias("params"), "score"), cfg.cache)


def _parameters(spark: SparkSession, cfg: PipelineConfig):
    """(family, crit, tag, mult, set, model) -> parameters: from the cache, where a missing entry is an error, or the defaults."""
    if cfg.cache is None:
        return lambda family, crit, tag, mult, sname, model: cfg.params[model]
    saved = {tuple(r[c] for c in SE.CACHE_KEYS): json.loads(r["params"]) for r in read_params(spark, cfg.cache).collect()}   # one row per model

    def get(family, crit, tag, mult, sname, model):
        key = (family, crit, tag, mult, _n(sname), model)
        if key not in saved:
            raise KeyError("no cached hyper-parameters for " + "/".join(map(str, key)))
        return saved[key]

    return get


# ---------------------------------------------------------------- training

def train_all(tables: DataFrame, sets: dict, cfg: PipelineConfig, feature_cols: list[str], big: dict | None = None) -> tuple[list[dict], list[dict]]:
    """Coefficient rows over ``feature_cols`` and perceptron rows of every (criterion, tag, mult, feature set).

    Dropped features get weight 0. Tables without rows are skipped. Models with equal parameters are fitted once; each
    training table is scaled once. Tables up to ``tablefits.MOST_VALUES`` numbers are fitted side by side in one pass.
    """
    spark = tables.sparkSession
    get = _parameters(spark, cfg)
    criteria = CRITERIA if cfg.cache is not None and tuple(cfg.criteria) == ("default",) else cfg.criteria
    there = {(r["tag"], r["mult"]): r["count"] for r in tables.groupBy("tag", "mult").count().collect()}   # configuration, not data

    def widen(row: dict, feats: list[str]) -> dict:
        w = dict(zip(feats, row["weights"]))
        return {"list_id": row["list_id"], "weights": [w.get(c, 0.0) for c in feature_cols], "bias": row["bias"]}

    def wanted(tag: str, m: int, sname: str) -> list[tuple[str, str, dict]]:
        out = []
        if "linear" in cfg.families:
            out += [(f"linear/{c}/{tag}/{m}x/{sname}/{k}", k, get("linear", c, tag, m, sname, k)) for c in criteria for k in TR.LINEAR_KINDS]
        if "nn" in cfg.families:
            out.append((f"nn/{tag}/{m}x/{sname}/mlp", "mlp", get("nn", "f1", tag, m, sname, "mlp")))
        return out

    def large(job: tuple) -> tuple[list[dict], list[dict]]:
        tag, m, sname, feats = job
        with TR.prepared(tables.where((F.col("tag") == tag) & (F.col("mult") == m)), feats) as p:
            todo = wanted(tag, m, sname)
            linear = [widen(r, feats) for r in TR.fit_linear_group(p, [w for w in todo if w[1] != "mlp"])]
            return linear, [TR.fit_mlp_prepared(p, q["hidden"], cfg.mlp_iter, cfg.seed, name) for name, k, q in todo if k == "mlp"]

    here = [(tag, m) for tag in cfg.tags for m in cfg.mults if (tag, m) in there]
    small = [x for x in here if there[x] * len(feature_cols) <= TF.MOST_VALUES]
    # small tables: all their fits in one pass, equal models once
    jobs, names, at = [], [], {c: i for i, c in enumerate(feature_cols)}
    for t, (tag, m) in enumerate(small):
        for sname, feats in sets.items():
            first = {}
            for name, k, q in wanted(tag, m, sname):
                key = TR.model_key(k, q)
                if key not in first:
                    first[key] = len(jobs)
                    jobs.append(TF.Job(t, k, q, tuple(at[c] for c in feats), cfg.seed, cfg.mlp_iter))
                names.append((name, k, first[key], feats))
    table = F.lit(-1)
    for t, (tag, m) in enumerate(small):
        table = F.when((F.col("tag") == tag) & (F.col("mult") == m), F.lit(t)).otherwise(table)
    found = TF.fit_all(tables, feature_cols, jobs, table)
    linear = [widen({"list_id": name, "weights": found[i]["weights"], "bias": found[i]["bias"]}, feats) for name, k, i, feats in names if k != "mlp"]
    mlps = [TR.mlp_row(found[i], feats, name) for name, k, i, feats in names if k == "mlp"]
    rest = [(tag, m, sname, feats) for tag, m in here if (tag, m) not in small for sname, feats in sets.items()]
    with ThreadPoolExecutor(max_workers=cfg.parallelism) as pool:   # each fit is a distributed job; the driver only waits
        for x, y in pool.map(large, rest):
            linear, mlps = linear + x, mlps + y
    if "smoteenn" in cfg.families:
        for tag, sname in product([t for t in cfg.tags if t in (big or {})], sets):
            rows = train_resampled(big[tag], sets[sname], f"smoteenn/{tag}/{sname}", lambda k, t=tag, s=sname: get("smoteenn", "f1", t, 0, s, k), cfg)
            linear += [widen(r, sets[sname]) for r in rows]
    return linear, mlps


def train_resampled(table: DataFrame, feats: list[str], prefix: str, params, cfg: PipelineConfig) -> list[dict]:
    """The linear trio on a table that is resampled in min-max space; each model scales what it is given by its own min and max.

    As in the reference, the saved model holds that inner scaling only.
    """
    rows, made = [], {}
    for kind in TR.LINEAR_KINDS:
        q = dict(params(kind))
        inner = json.loads(q["params"]) if "params" in q else q
        ks = (q.get("smote_k", cfg.params["resampler"]["smote_k"]), q.get("enn_k", cfg.params["resampler"]["enn_k"]))
        made.setdefault(ks, []).append((f"{prefix}/{kind}", kind, inner))
    for (k1, k2), wanted in made.items():
        res = materialise(smote_enn(table.select("NAME", *feats, "CLASS"), feats, k1, k2, cfg.seed), "resampled")
        with TR.prepared(res, feats, scaler="minmax") as p:
            rows += TR.fit_linear_group(p, wanted)
    return rows


def resampled_models(models: DataFrame, tag: str, set_: str) -> DataFrame:
    """The resampled models of one tag and feature set; logistic regression and the partial-fit twin are required, SGD is not."""
    prefix = f"smoteenn/{tag}/{set_}/"
    mine = models.where(F.startswith("list_id", F.lit(prefix)))
    have = {r["list_id"].removeprefix(prefix) for r in mine.select("list_id").collect()}   # three names
    if missing := {"logreg", "sgd_partial"} - have:
        raise FileNotFoundError(f"missing models: {sorted(prefix + x for x in missing)}")
    return mine


# ---------------------------------------------------------------- the whole flow (F8)

def window_source(seqs: DataFrame, cfg: PipelineConfig) -> SA.Source:
    """The composition table of all windows as something to draw from: counted from lengths, hashed where the windows are cut."""
    n = window_counts(seqs, cfg.window, cfg.step, cfg.min_len).agg(F.sum("n_windows")).first()[0]
    return SA.Source(n or 0, lambda seeds, bounds: composition_near(seqs, RESIDUES, seeds, bounds, cfg.window, cfg.step, cfg.min_len))


def control_pools(cfg: PipelineConfig, reference: DataFrame, ids: DataFrame, n_pos: int, reference_features: DataFrame | None = None) -> dict:
    """the pool of each tag. The random one holds ``random_control_n`` windows, or as many as the largest multiple of ``n_pos`` positives draws from it."""
    n, out = max([cfg.random_control_n, *(int(m) * n_pos for m in cfg.mults)]), {}
    if "PTM" in cfg.tags:
        out["PTM"] = featurize(CO.sequences_by_ids(reference, ids), cfg) if reference_features is None else CO.control_by_ids(reference_features, ids)
    if "Random" in cfg.tags:
        if reference_features is None:
            others = CO.sequences_by_ids(reference, ids, exclude=True)
            out["Random"] = CO.random_controls(featurize(others, cfg), n, cfg.seed, source=window_source(others, cfg))
        else:
            out["Random"] = CO.random_controls(reference_features, n, cfg.seed, ids)
    return out


def run(spark: SparkSession, cfg: PipelineConfig, positives: DataFrame, reference: DataFrame, ids: DataFrame,
        positive_features: DataFrame | None = None, reference_features: DataFrame | None = None) -> dict:
    """F8: returns the stage DataFrames (``tables``, ``models``, ``mlps``, ``consensus``, ``regions``, ``fasta``).

    With precomputed feature tables those are used and scored instead of window text. Records that share an ID vote
    once per window name, and regions are cut from the one record per ID that the lookup keeps.
    """
    pos = featurize(positives, cfg, positive_features)
    names = composition_names() if positive_features is None else feature_columns(pos)
    pos = materialise(pos.select("NAME", *names), "positives")
    n_pos = pos.count()
    ref = None if reference_features is None else ingest_features(reference_features).select("NAME", *names)
    sources = {}
    if ref is None and "PTM" in cfg.tags and "smoteenn" not in cfg.families:   # nothing but draws reads this pool
        source = window_source(CO.sequences_by_ids(reference, ids), cfg)
        if source.rows > POOL_TIMES * n_pos * max(cfg.mults):
            sources["PTM"] = source
    pools = {k: v.select("NAME", *names) if k in sources else materialise(v.select("NAME", *names), f"pool {k}") for k, v in control_pools(cfg, reference, ids, n_pos, ref).items()}
    tables = materialise(CO.training_tables(pos, pools, n_pos, cfg.mults, cfg.seed, sources=sources), "training tables")
    big = {k: CO.label_union(pos, v) for k, v in pools.items()} if "smoteenn" in cfg.families else {}
    first = tables.where((F.col("tag") == cfg.tags[0]) & (F.col("mult") == cfg.mults[0]))
    sets = feature_sets(first, names, cfg)
    if cfg.cache is not None:
        search_all(spark, tables, big, sets, cfg)
    linear, mlps = train_all(tables, sets, cfg, names, big)
    models = Models.of(linear, mlps, names)
    if reference_features is None:
        cons = flows.consensus_windows(WindowScores(reference, models, RESIDUES, cfg.window, cfg.step, cfg.min_len), cfg.thresholds)
    else:
        cons = consensus_table(ref, models, names, cfg.thresholds)
    regions = materialise(flows.consensus_regions(cons, cfg.window, cfg.min_frags), "regions")
    lookup = sequence_lookup(reference, only=regions)   # only the regions' parents travel
    return {"tables": tables, "feature_sets": sets, "models": TR.coefficient_table(spark, linear), "mlps": TR.mlp_table(spark, mlps), "consensus": cons, "regions": regions,
            "fasta": flows.region_fasta(regions, lookup)}


def consensus_table(features: DataFrame, models: Models, names: list[str], thresholds) -> DataFrame:
    """F5 over an ingested feature table: ``(pct, name, seq_id, start, support)``; votes of a name that repeats are united."""
    from motifspark.functions.ids import split_fragment_id
    scored = dedupe_support(score_features(features, models, names, ["NAME"], least=1), "NAME", models.n_words)
    scored = materialise(scored, "table scores")   # N and the votes are read from one scoring pass
    n = scored.select(n_lists_of(scored, models.n_words).alias("n")).limit(1).collect()
    if not n:
        raise NoLists("all prediction lists are empty")
    seq_id, start = split_fragment_id(F.col("NAME"))
    return consensus(scored.select(F.col("NAME").alias("name"), seq_id.alias("seq_id"), start.alias("start"), "support"), F.lit(n[0]["n"]).cast("bigint"), thresholds, keep=("seq_id", "start"))


__all__ = ["PipelineConfig", "run", "feature_sets", "train_all", "search_all", "resampled_models", "set_name", "RESIDUES"]
