"""Registered queries: one per operator family of the inventory, each over the
whole test tables, plus the DuckDB SQL that must give the same rows.

Doubles are rounded to 6 places on both sides; every computed column is aliased.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from motifspark.functions.ids import id_part, split_fragment_id
from motifspark.functions.text import RESIDUES
from motifspark.operators import consensus as C
from motifspark.operators.features import composition_features
from motifspark.operators.regions import merge_regions, parse_fragments
from motifspark.operators.windows import sliding_windows, window_counts
from motifspark.plans import flows
from motifspark.plans.runplan import THRESHOLDS
from motifspark.sources import oracle as O
from motifspark.sources import views as V

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- windows

@query("windows", _with(O.sequences_cte(), O.windows_cte()) + "SELECT name, seq_id, start, sub FROM windows")
def q_windows(spark: SparkSession, d: str) -> DataFrame:
    return V.windows(spark, d)


@query("window_counts", _with(O.sequences_cte(), O.windows_cte()) +
       "SELECT seq_id, count(*) AS n_windows FROM windows GROUP BY seq_id")
def q_window_counts(spark, d):
    return window_counts(V.sequences(spark, d))


@query("windows_step3", _with(O.sequences_cte()) +
       "SELECT seq_id || ':' || CAST(k AS VARCHAR) AS name, seq_id, CAST(st AS INTEGER) AS start, substr(seq, st, 12) AS sub "
       "FROM (SELECT seq_id, seq, st, row_number() OVER (PARTITION BY seq_id ORDER BY st) AS k FROM "
       "(SELECT seq_id, seq, unnest(range(1, length(seq) - 12 + 2, 3)) AS st FROM sequences WHERE length(seq) >= 20))")
def q_windows_step3(spark, d):
    """W4 index mode, step 3, window 12, min length 20."""
    from motifspark.operators.windows import sliding_windows
    return sliding_windows(V.sequences(spark, d), w=12, step=3, min_len=20, id_mode="index")


# ---------------------------------------------------------------- composition features

def _sql_round(cols, expr="{c}"):
    return ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in cols)


_FB = [f"f_{a}" for a in RESIDUES]


@query("composition_features", _with(O.sequences_cte(), O.windows_cte(), O.features_big_cte()) +
       "SELECT NAME, " + _sql_round(_FB) + " FROM features_big")
def q_composition(spark, d):
    return flows.window_features(V.sequences(spark, d), digits=6).select("NAME", *_FB)


# ---------------------------------------------------------------- all-model scoring

def _scores(spark, d):
    return flows.window_scores(V.sequences(spark, d), V.models_linear(spark))


@query("score_all_models", _with(O.sequences_cte(), O.windows_cte(), O.features_big_cte(), O.models_cte()) +
       f", h AS (SELECT *, CAST(CAST(('0x' || substr(md5(NAME), 1, 8)) AS UBIGINT) AS BIGINT) AS h FROM features_big) "
       f"SELECT m.list_id, count(*) AS n_positive, CAST(sum(f.h) AS BIGINT) AS name_sum FROM h f, models m WHERE {O.margin_expr()} <= 0 GROUP BY m.list_id")
def q_score_all(spark, d):
    """All 172 lists as digests: their lengths and the sums of their names' hashes."""
    return _scores(spark, d).list_digests()


_SCORED_SQL = _with(O.sequences_cte(), O.windows_cte(), O.features_big_cte(), O.models_cte(),
                    f"support AS (SELECT f.NAME AS name, f.seq_id, f.start, count(*) AS support FROM features_big f, models m "
                    f"WHERE {O.margin_expr()} <= 0 GROUP BY f.NAME, f.seq_id, f.start)",
                    f"per_model AS (SELECT m.list_id, count(*) AS c FROM features_big f, models m WHERE {O.margin_expr()} <= 0 GROUP BY m.list_id)",
                    "nl AS (SELECT count(*) AS n FROM per_model)",
                    "th AS (SELECT unnest([100, 95, 90, 85]) AS pct)",
                    "cons AS (SELECT th.pct, s.name, s.seq_id, s.start, s.support FROM support s, th, nl "
                    "WHERE s.support >= ceil(CAST(th.pct AS DOUBLE) / 100.0 * CAST(nl.n AS DOUBLE)))")


def _islands_sql(src: str, keys: str, w: int = 15, min_frags: int = 2) -> str:
    """Plain gaps-and-islands over ``src(keys..., seq_id, start)`` (distinct starts)."""
    k = keys + ", " if keys else ""
    return (f"SELECT {k}seq_id, min(start) AS start, max(start) + {w - 1} AS \"end\", count(*) AS n_frags FROM ("
            f"SELECT *, sum(CASE WHEN prev IS NULL OR start > prev + {w - 1} THEN 1 ELSE 0 END) "
            f"OVER (PARTITION BY {k}seq_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS isl FROM ("
            f"SELECT {k}seq_id, start, lag(start) OVER (PARTITION BY {k}seq_id ORDER BY start) AS prev "
            f"FROM (SELECT DISTINCT {k}seq_id, start FROM {src}))) "
            f"GROUP BY {k}seq_id, isl HAVING count(*) >= {min_frags}")


@query("consensus_scored", _SCORED_SQL + "SELECT pct, name, support FROM cons")
def q_consensus_scored(spark, d):
    return flows.consensus_windows(_scores(spark, d)).select("pct", "name", "support")


@query("regions_all", _SCORED_SQL + _islands_sql("cons", "pct"))
def q_regions_all(spark, d):
    return flows.consensus_regions(flows.consensus_windows(_scores(spark, d)))


_WRAP_SQL = ("array_to_string(list_transform(range(0, length(r), 60), lambda i: substr(r, i + 1, 60)), chr(10))")


@query("region_fasta", _SCORED_SQL + ", regions AS (" + _islands_sql("cons", "pct") + ")\n" +
       "SELECT g.pct, g.seq_id, g.start, g.\"end\", g.n_frags, '>' || g.seq_id || ':' || CAST(g.start AS VARCHAR) || '-' || "
       "CAST(g.\"end\" AS VARCHAR) || '|n_frags=' || CAST(g.n_frags AS VARCHAR) AS header, r AS residues, "
       "'>' || g.seq_id || ':' || CAST(g.start AS VARCHAR) || '-' || CAST(g.\"end\" AS VARCHAR) || '|n_frags=' || "
       f"CAST(g.n_frags AS VARCHAR) || chr(10) || {_WRAP_SQL} AS record "
       "FROM (SELECT g.*, substr(s.seq, g.start, g.\"end\" - g.start + 1) AS r FROM regions g JOIN sequences s USING (seq_id) "
       "WHERE g.start >= 1 AND g.\"end\" <= length(s.seq) AND g.start <= g.\"end\") g")
def q_region_fasta(spark, d):
    regions = flows.consensus_regions(flows.consensus_windows(_scores(spark, d)))
    return flows.region_fasta(regions, V.sequences(spark, d))


# ---------------------------------------------------------------- voting over lists

_VW = _with(O.votes_wide_cte(),
            "clean AS (SELECT DISTINCT list_id, trim(name) AS name FROM votes_wide WHERE length(trim(name)) > 0)",
            "sup AS (SELECT name, count(*) AS support FROM clean GROUP BY name)",
            "nl AS (SELECT count(DISTINCT list_id) AS n FROM clean)",
            "th AS (SELECT unnest([100, 95, 90, 85]) AS pct)",
            "cons AS (SELECT th.pct, s.name, s.support FROM sup s, th, nl "
            "WHERE s.support >= ceil(CAST(th.pct AS DOUBLE) / 100.0 * CAST(nl.n AS DOUBLE)))")


@query("fragment_support", _VW + "SELECT name, support FROM sup")
def q_fragment_support(spark, d):
    return C.fragment_support(V.votes_wide(spark, d))


@query("support_summary", _VW + "SELECT nl.n AS n_lists, (SELECT count(*) FROM sup) AS n_unique, "
       "(SELECT max(support) FROM sup) AS max_support, "
       "round(100.0 * (SELECT max(support) FROM sup) / CAST(nl.n AS DOUBLE), 2) AS max_pct FROM nl")
def q_support_summary(spark, d):
    v = V.votes_wide(spark, d)
    return C.support_summary(C.fragment_support(v), C.n_lists(v))


@query("consensus", _VW + "SELECT pct, name, support FROM cons")
def q_consensus(spark, d):
    return C.consensus_from_pairs(V.votes_wide(spark, d))


@query("consensus_counts", _VW + "SELECT th.pct, CAST(ceil(CAST(th.pct AS DOUBLE) / 100.0 * CAST(nl.n AS DOUBLE)) AS BIGINT) AS k, "
       "(SELECT count(*) FROM cons c WHERE c.pct = th.pct) AS n_kept FROM th, nl")
def q_consensus_counts(spark, d):
    v = V.votes_wide(spark, d)
    n = C.n_lists(v)
    return C.consensus_counts(C.consensus(C.fragment_support(v), n), n)


@query("top_fragments", _VW + "SELECT name, support FROM sup ORDER BY support DESC, name LIMIT 20")
def q_top(spark, d):
    return C.top_fragments(C.fragment_support(V.votes_wide(spark, d)), 20)


@query("uniq_lists", _VW + "SELECT list_id, name FROM clean")
def q_uniq(spark, d):
    return C.uniq_lists(V.votes_wide(spark, d))


# ---------------------------------------------------------------- regions over voted lists

@query("merge_regions", _VW + "," + "frag AS (SELECT pct, regexp_extract(name, '^(.*):', 1) AS seq_id, "
       "CAST(split_part(name, ':', -1) AS INTEGER) AS start FROM cons)\n" + _islands_sql("frag", "pct"))
def q_merge_regions(spark, d):
    cons = C.consensus_from_pairs(V.votes_wide(spark, d))
    return merge_regions(parse_fragments(cons, "name", keys=("pct",)), w=15, min_frags=2, keys=("pct",))


@query("merge_regions_tight", _VW + "," + "frag AS (SELECT pct, regexp_extract(name, '^(.*):', 1) AS seq_id, "
       "CAST(split_part(name, ':', -1) AS INTEGER) AS start FROM cons)\n" + _islands_sql("frag", "pct", w=2, min_frags=1))
def q_merge_regions_tight(spark, d):
    """Window 2, min 1 fragment: many islands, touching starts stay apart."""
    cons = C.consensus_from_pairs(V.votes_wide(spark, d))
    return merge_regions(parse_fragments(cons, "name", keys=("pct",)), w=2, min_frags=1, keys=("pct",))


@query("parse_fragment_id", _with(O.sequences_cte(), O.windows_cte()) +
       "SELECT name, regexp_extract(name, '^(.*):', 1) AS seq_id, CAST(split_part(name, ':', -1) AS INTEGER) AS start, "
       "split_part(name, ':', 1) AS id FROM windows")
def q_parse(spark, d):
    w = V.windows(spark, d)
    seq_id, start = split_fragment_id(F.col("name"))
    return w.select("name", seq_id.alias("seq_id"), start.alias("start"), id_part("name").alias("id"))


# ---------------------------------------------------------------- feature cleaning

from motifspark.operators import features as FE  # noqa: E402
from motifspark.operators import sampling as SA  # noqa: E402
from motifspark.operators import controls as CO  # noqa: E402
from motifspark.operators import scaling as SC  # noqa: E402
from motifspark.operators import metrics as ME  # noqa: E402
from motifspark.operators import importance as IM  # noqa: E402

_F64 = [f"f{i}" for i in range(64)]


def _round_cols(df, cols):
    s = set(cols)
    return df.select(*[r6(F.col(c)).alias(c) if c in s else F.col(c) for c in df.columns])


@query("fill_missing", _with(O.features_dirty_cte()) +
       "SELECT NAME, " + _sql_round(_F64, "CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END") + ", CLASS FROM features_dirty")
def q_fill_missing(spark, d):
    return _round_cols(FE.fill_missing(V.features_dirty(spark, d), _F64), _F64)


@query("clean_features", _with(O.features_dirty_cte()) +
       "SELECT NAME, " + _sql_round(_F64, "CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 ELSE {c} END") +
       ", CLASS FROM features_dirty")
def q_clean_features(spark, d):
    return _round_cols(FE.clean_features(V.features_dirty(spark, d), _F64), _F64)


@query("coerce_numeric", _with(O.features_text_cte()) +
       "SELECT NAME, " + ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in ("t0", "t1", "t2")) +
       " FROM features_text")
def q_coerce(spark, d):
    return FE.coerce_numeric(V.features_text(spark, d), ["t0", "t1", "t2"])


_DROP = [f"f{i}" for i in range(0, 64, 3)] + ["idr_name", "not_there"]
_KEEP_AFTER_DROP = [c for c in _F64 if c not in _DROP]


@query("drop_columns", _with(O.features_small_cte()) +
       "SELECT NAME, " + _sql_round(_KEEP_AFTER_DROP) + " FROM features_small")
def q_drop_columns(spark, d):
    df = FE.drop_columns(V.features_small(spark, d), _DROP + ["CLASS"])
    return _round_cols(df, _KEEP_AFTER_DROP)


_SET = ["f5", "f17", "f42", "f63"]


@query("project_feature_set", _with(O.features_small_cte()) + "SELECT NAME, " + _sql_round(_SET) + " FROM features_small")
def q_project(spark, d):
    return _round_cols(FE.project_feature_set(V.features_small(spark, d), _SET), _SET)


@query("labelled_matrix", _with(O.features_dirty_cte()) +
       "SELECT NAME, [" + ", ".join(f"round(CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 ELSE {c} END, 6)" for c in _F64) +
       "] AS features, CLASS AS label FROM features_dirty")
def q_labelled(spark, d):
    df = FE.clean_features(V.features_dirty(spark, d), _F64)
    m = FE.assemble(df, _F64, "CLASS", expected=64, as_vector=False)
    return m.select("NAME", F.transform("features", lambda x: F.round(x, 6)).alias("features"), "label")


@query("id_part", _with(O.features_small_cte()) + "SELECT NAME, split_part(NAME, ':', 1) AS id FROM features_small")
def q_id_part(spark, d):
    return V.features_small(spark, d).select("NAME", id_part("NAME").alias("id"))


@query("class_counts", _with(O.features_small_cte()) + "SELECT CLASS, count(*) AS n FROM features_small GROUP BY CLASS")
def q_class_counts(spark, d):
    return SA.class_counts(V.features_small(spark, d))


# ---------------------------------------------------------------- controls and sampling

_REF = _with(O.sequences_cte(), O.windows_cte(), O.features_big_cte(), O.id_list_cte(), O.benchmark_windows_cte())


def _names(seqs):
    return sliding_windows(seqs).select(F.col("name").alias("NAME"))


@query("control_by_ids", _REF + "SELECT NAME, " + _sql_round(_FB) +
       " FROM features_big WHERE split_part(NAME, ':', 1) IN (SELECT id FROM id_list)")
def q_control_by_ids(spark, d):
    return flows.window_features(CO.sequences_by_ids(V.sequences(spark, d), V.id_list(spark, d)), digits=6).select("NAME", *_FB)


@query("control_exclude", _REF + "SELECT NAME FROM features_big WHERE split_part(NAME, ':', 1) NOT IN (SELECT id FROM id_list)")
def q_control_exclude(spark, d):
    return _names(CO.sequences_by_ids(V.sequences(spark, d), V.id_list(spark, d), exclude=True))


@query("sample_n", _REF + "SELECT NAME, " + _sql_round(_FB) + " FROM features_big WHERE split_part(NAME, ':', 1) NOT IN "
       "(SELECT id FROM id_list) ORDER BY md5('42:' || NAME), NAME LIMIT 2000")
def q_sample_n(spark, d):
    rest = CO.sequences_by_ids(V.sequences(spark, d), V.id_list(spark, d), exclude=True)
    return _round_cols(CO.random_controls(composition_features(sliding_windows(rest)), 2000, 42), _FB)


@query("short_buckets", _REF + ", npos AS (SELECT count(*) AS n FROM pos_windows), "
       "pool AS (SELECT NAME FROM features_big WHERE split_part(NAME, ':', 1) NOT IN (SELECT id FROM id_list)), "
       "mults AS (SELECT unnest([1, 2, 5, 10]) AS mult) "
       "SELECT mult, NAME FROM (SELECT mult, NAME, row_number() OVER (PARTITION BY mult ORDER BY "
       "md5(CAST(7 + mult AS VARCHAR) || ':' || NAME), NAME) AS rn FROM pool, mults) t, npos WHERE rn <= mult * npos.n")
def q_short_buckets(spark, d):
    n_pos = V.positive_features(spark, d).count()
    pool = _names(CO.sequences_by_ids(V.sequences(spark, d), V.id_list(spark, d), exclude=True))
    return SA.bucket_samples(pool, n_pos, (1, 2, 5, 10), seed=7).select("mult", "NAME")


@query("stratified_split", _with(O.features_small_cte()) +
       ", sizes AS (SELECT CLASS, count(*) AS n FROM features_small GROUP BY CLASS) "
       "SELECT f.NAME, f.CLASS, (row_number() OVER (PARTITION BY f.CLASS ORDER BY md5('3:' || f.NAME), f.NAME) "
       "<= round(0.2 * s.n)) AS is_test FROM features_small f JOIN sizes s USING (CLASS)")
def q_split(spark, d):
    return SA.stratified_split(V.features_small(spark, d).select("NAME", "CLASS"), seed=3)


@query("label_union", _REF + ", pos AS (SELECT name AS NAME, " + ", ".join(O.composition_exprs()) + " FROM pos_windows) "
       "SELECT NAME, " + _sql_round(_FB) + ", 0 AS CLASS FROM pos UNION ALL SELECT NAME, " + _sql_round(_FB) +
       ", 1 AS CLASS FROM features_big WHERE split_part(NAME, ':', 1) IN (SELECT id FROM id_list)")
def q_label_union(spark, d):
    u = CO.label_union(V.positive_features(spark, d), composition_features(sliding_windows(CO.sequences_by_ids(V.sequences(spark, d), V.id_list(spark, d)))))
    return _round_cols(u, _FB)


@query("training_tables", _REF + ", npos AS (SELECT count(*) AS n FROM pos_windows), "
       "ptm AS (SELECT NAME FROM features_big WHERE split_part(NAME, ':', 1) IN (SELECT id FROM id_list)), "
       "rnd AS (SELECT NAME FROM features_big WHERE split_part(NAME, ':', 1) NOT IN (SELECT id FROM id_list)), "
       "mults AS (SELECT unnest([1, 2, 5, 10]) AS mult), "
       "pools AS (SELECT 'PTM' AS tag, NAME FROM ptm UNION ALL SELECT 'Random' AS tag, NAME FROM rnd), "
       "ctrl AS (SELECT tag, mult, NAME FROM (SELECT tag, mult, NAME, row_number() OVER (PARTITION BY tag, mult ORDER BY "
       "md5(CAST(11 + mult AS VARCHAR) || ':' || NAME), NAME) AS rn FROM pools, mults) t, npos WHERE rn <= mult * npos.n) "
       "SELECT tag, mult, NAME, 1 AS CLASS FROM ctrl UNION ALL "
       "SELECT tag, mult, name AS NAME, 0 AS CLASS FROM pos_windows, (SELECT DISTINCT tag FROM pools) t2, mults")
def q_training_tables(spark, d):
    pos = V.positive_features(spark, d).select("NAME")
    n_pos = pos.count()
    seqs, ids = V.sequences(spark, d), V.id_list(spark, d)
    pools = {"PTM": _names(CO.sequences_by_ids(seqs, ids)), "Random": _names(CO.sequences_by_ids(seqs, ids, exclude=True))}
    return CO.training_tables(pos, pools, n_pos, (1, 2, 5, 10), seed=11).select("tag", "mult", "NAME", "CLASS")


# ---------------------------------------------------------------- scaling

@query("standard_scale", _with(O.features_small_cte()) + ", st AS (SELECT " +
       ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _F64) + " FROM features_small) SELECT NAME, " +
       _sql_round(_F64, "CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END") + ", CLASS FROM features_small, st")
def q_standard(spark, d):
    return _round_cols(SC.standard_scale(V.features_small(spark, d), _F64), _F64)


@query("minmax_scale", _with(O.features_small_cte()) + ", st AS (SELECT " +
       ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _F64) + " FROM features_small) SELECT NAME, " +
       _sql_round(_F64, "CASE WHEN hi_{c} = lo_{c} THEN 0.0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END") +
       ", CLASS FROM features_small, st")
def q_minmax(spark, d):
    return _round_cols(SC.minmax_scale(V.features_small(spark, d), _F64), _F64)


# ---------------------------------------------------------------- metrics and best candidate

_MET_SQL = _with(O.candidates_cte(),
                 "cm AS (SELECT cand, grid_ord, sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp, "
                 "sum(CASE WHEN y_true <> 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp, "
                 "sum(CASE WHEN y_true = 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS fn, "
                 "sum(CASE WHEN y_true <> 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS tn FROM candidates GROUP BY cand, grid_ord)",
                 "met AS (SELECT cand, grid_ord, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
                 "CAST(tn AS BIGINT) AS tn, "
                 "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision, "
                 "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall, "
                 "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1, "
                 "CASE WHEN 1.25 * tp + 0.25 * fn + fp = 0 THEN 0.0 ELSE 1.25 * tp / CAST(1.25 * tp + 0.25 * fn + fp AS DOUBLE) END AS fbeta "
                 "FROM cm)")


@query("classification_metrics", _MET_SQL + "SELECT cand, tp, fp, fn, tn, round(precision, 6) AS precision, "
       "round(recall, 6) AS recall, round(f1, 6) AS f1, round(fbeta, 6) AS fbeta FROM met")
def q_metrics(spark, d):
    m = ME.classification_metrics(V.candidates(spark, d), ("cand",))
    return _round_cols(m, ["precision", "recall", "f1", "fbeta"])


@query("best_params", _MET_SQL + "SELECT crit, best, round(score, 6) AS score FROM ("
       "SELECT 'f1' AS crit, arg_max(cand, (f1, -grid_ord)) AS best, max(f1) AS score FROM met UNION ALL "
       "SELECT 'max_recall', arg_max(cand, (recall, -grid_ord)), max(recall) FROM met UNION ALL "
       "SELECT 'fbeta', arg_max(cand, (fbeta, -grid_ord)), max(fbeta) FROM met)")
def q_best(spark, d):
    m = ME.classification_metrics(V.candidates(spark, d), ("cand", "grid_ord"))
    return _round_cols(ME.best_candidates(m), ["score"])


# ---------------------------------------------------------------- importance selection

_IMP = _with(O.features_small_cte(), O.importance_cte(),
             "cum AS (SELECT feature, importance, sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) "
             "/ CASE WHEN sum(importance) OVER () = 0 THEN 1.0 ELSE sum(importance) OVER () END AS cum_fraction, "
             "row_number() OVER (ORDER BY importance DESC, feature) AS pos FROM importance)",
             "sel AS (SELECT t.set_name, t.threshold, c.pos, c.feature FROM (SELECT *, coalesce(lag(cum_fraction) OVER (ORDER BY pos), 0.0) "
             "AS prev FROM cum) c, (SELECT 'cum90' AS set_name, 0.9 AS threshold UNION ALL SELECT 'cum95', 0.95) t "
             "WHERE c.prev <= t.threshold OR c.pos = 1)")


@query("cum_importance", _IMP + "SELECT feature, round(importance, 6) AS importance, round(cum_fraction, 6) AS cum_fraction, pos FROM cum")
def q_cum(spark, d):
    return _round_cols(IM.cum_importance(V.importance(spark, d)), ["importance", "cum_fraction"])


@query("feature_select", _IMP + "SELECT set_name, CAST(threshold AS DOUBLE) AS threshold, pos, feature FROM sel")
def q_feature_select(spark, d):
    return IM.feature_select(IM.cum_importance(V.importance(spark, d)), (0.90, 0.95))


@query("derive_drop_list", _IMP + "SELECT t.set_name, i.feature FROM importance i, (SELECT DISTINCT set_name FROM sel) t "
       "WHERE NOT EXISTS (SELECT 1 FROM sel s WHERE s.set_name = t.set_name AND s.feature = i.feature)")
def q_drop_list(spark, d):
    imp = V.importance(spark, d)
    sel = IM.feature_select(IM.cum_importance(imp), (0.90, 0.95))
    return IM.derive_drop_list(imp, sel, (0.90, 0.95))


# ---------------------------------------------------------------- sequence sources

def _bench_as_docs(spark, d):
    """benchmark passages keyed like documents ('D' || item_id): a second, later source."""
    return V.benchmark_sequences(spark, d, prefix="D")


_SRC_SQL = _with(O.sequences_cte(),
                 f"bseq AS (SELECT 'D' || CAST(item_id AS VARCHAR) AS seq_id, upper(regexp_replace(text, '{O.NOT_RES}', '', 'g')) "
                 "AS seq, 'benchmark' AS source FROM benchmark)")


@query("sequence_lookup", _SRC_SQL + "SELECT s.seq_id, coalesce(b.seq, s.seq) AS seq FROM sequences s LEFT JOIN bseq b USING (seq_id) "
       "UNION ALL SELECT seq_id, seq FROM bseq WHERE seq_id NOT IN (SELECT seq_id FROM sequences)")
def q_sequence_lookup(spark, d):
    from motifspark.sources.fasta import sequence_lookup
    a = V.sequences(spark, d).select("seq_id", "seq", F.lit(0).alias("file_ord"), F.lit(0).cast("bigint").alias("pos_block"),
                                     F.lit(0).cast("bigint").alias("pos_row"))
    b = _bench_as_docs(spark, d).select("seq_id", "seq", F.lit(1).alias("file_ord"), F.lit(0).cast("bigint").alias("pos_block"),
                                        F.lit(0).cast("bigint").alias("pos_row"))
    return sequence_lookup(a.unionByName(b))


@query("concat_sequences", _SRC_SQL + "SELECT seq_id, seq, source FROM sequences UNION ALL SELECT seq_id, seq, source FROM bseq")
def q_concat(spark, d):
    return V.sequences(spark, d).drop("raw_len").unionByName(_bench_as_docs(spark, d))


# ---------------------------------------------------------------- single-model-group prediction

_TRIO = "linear/f1/PTM/1x/feats69/"


@query("predict_linear", _with(O.sequences_cte(), O.windows_cte(), O.features_big_cte(), O.models_cte()) +
       f"SELECT m.list_id, f.NAME AS name FROM features_big f, models m WHERE m.list_id LIKE '{_TRIO}%' AND {O.margin_expr()} <= 0")
def q_predict_linear(spark, d):
    from motifspark.operators.predict import prediction_pairs
    models = V.models_linear(spark).where(F.col("list_id").startswith(_TRIO))
    scores = flows.window_scores(V.sequences(spark, d), models)
    return prediction_pairs(scores.rows(1), scores.models)


# ---------------------------------------------------------------- kNN and resampling

_KNN_SQL = _with(O.features_small_cte(),
                 "pts AS (SELECT NAME, CLASS, [" + ", ".join(f"f{i}" for i in range(64)) + "] AS x FROM features_small)",
                 "d AS (SELECT a.NAME AS id, b.NAME AS nid, sqrt(list_sum(list_transform(list_zip(a.x, b.x), "
                 "lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist FROM pts a, pts b WHERE a.NAME <> b.NAME)",
                 "r AS (SELECT id, nid, dist, row_number() OVER (PARTITION BY id ORDER BY dist, nid) AS rank FROM d)")


def _small_pts(spark, d):
    fs = V.features_small(spark, d)
    return fs.select("NAME", "CLASS", F.array(*[F.col(f"f{i}") for i in range(64)]).alias("x"))


@query("knn_join", _KNN_SQL + "SELECT id, nid, round(dist, 6) AS dist, rank FROM r WHERE rank <= 5")
def q_knn(spark, d):
    from motifspark.operators.knn import knn
    out = knn(_small_pts(spark, d).select("NAME", "x"), 5, block_rows=128)
    return out.select("id", "nid", r6(F.col("dist")).alias("dist"), "rank")


@query("knn_pivots", _KNN_SQL + "SELECT id, nid, round(dist, 6) AS dist, rank FROM r WHERE rank <= 5")
def q_knn_pivots(spark, d):
    """The plan that large references take: cells of pivots, bounds, probes."""
    from motifspark.operators.knn import knn
    out = knn(_small_pts(spark, d).select("NAME", "x"), 5, block_rows=128, broadcast_bytes=0)
    return out.select("id", "nid", r6(F.col("dist")).alias("dist"), "rank")


@query("edited_nn", _KNN_SQL + ", v AS (SELECT r.id, sum(CASE WHEN p.CLASS = q.CLASS THEN 1 ELSE 0 END) AS same, count(*) AS n "
       "FROM r JOIN pts p ON p.NAME = r.nid JOIN pts q ON q.NAME = r.id WHERE r.rank <= 3 GROUP BY r.id) "
       "SELECT NAME, CLASS FROM features_small WHERE NAME NOT IN (SELECT id FROM v WHERE same < n)")
def q_enn(spark, d):
    from motifspark.operators.knn import edited_nn
    return edited_nn(V.features_small(spark, d), _F64, k=3, block_rows=128).select("NAME", "CLASS")


def _smote_ctes(src: str, k: int, seed: int) -> str:
    """SMOTE over ``src(NAME, CLASS, x)``: the same md5 choices in SQL -> ``smoted(NAME, CLASS, x)``."""
    h = "CAST(CAST(('0x' || substr(md5({}), 1, 8)) AS UBIGINT) AS BIGINT)"
    pick, gap = (h.format(f"'{seed}:' || g.NAME || ':' || CAST(g.j AS VARCHAR) || ':{x}'") for x in ("nn", "u"))
    return (f"sizes AS (SELECT CLASS, count(*) AS n FROM {src} GROUP BY CLASS), "
            f"mino AS (SELECT arg_min(CLASS, (n, CLASS)) AS c, min(n) AS n, max(n) - min(n) AS need FROM sizes), "
            f"mins AS (SELECT p.NAME, p.x, p.CLASS FROM {src} p, mino WHERE p.CLASS = mino.c), "
            "md AS (SELECT a.NAME AS id, b.NAME AS nid, list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2 "
            "FROM mins a, mins b WHERE a.NAME <> b.NAME), "
            "mr AS (SELECT id, nid, row_number() OVER (PARTITION BY id ORDER BY d2, nid) AS rank FROM md), "
            f"cnt AS (SELECT mins.*, mino.need // mino.n + CASE WHEN row_number() OVER (ORDER BY md5('{seed}:extra:' || NAME), NAME) <= mino.need % mino.n "
            "THEN 1 ELSE 0 END AS c, mino.n AS n_min FROM mins, mino), "
            "g AS (SELECT NAME, x, CLASS, n_min, unnest(range(0, c)) AS j FROM cnt), "
            f"gp AS (SELECT g.*, {pick} % least({k}, n_min - 1) + 1 AS rank, {gap} / 4294967296.0 AS u FROM g), "
            "syn AS (SELECT gp.NAME || '#s' || CAST(gp.j AS VARCHAR) AS NAME, gp.CLASS, "
            "list_transform(list_zip(gp.x, o.x), lambda p: p[1] + gp.u * (p[2] - p[1])) AS x "
            "FROM gp JOIN mr ON mr.id = gp.NAME AND mr.rank = gp.rank JOIN mins o ON o.NAME = mr.nid), "
            f"smoted AS (SELECT NAME, CLASS, x FROM {src} UNION ALL SELECT NAME, CLASS, x FROM syn)")


_X64 = "[" + ", ".join(f"f{i}" for i in range(64)) + "]"
_UNPACK = ", ".join(f"round(x[{i + 1}], 6) AS f{i}" for i in range(64))


@query("smote", _with(O.features_small_cte(), f"pts AS (SELECT NAME, CLASS, {_X64} AS x FROM features_small)", _smote_ctes("pts", 5, 1)) +
       f"SELECT NAME, CLASS, {_UNPACK} FROM smoted")
def q_smote(spark, d):
    """Input and synthetic rows; every choice comes from md5, so SQL makes the same rows."""
    from motifspark.operators.knn import smote
    return _round_cols(smote(V.features_small(spark, d), _F64, k=5, seed=1), _F64)


@query("smote_enn", _with(O.features_small_cte(), "st AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _F64) + " FROM features_small)",
                          "pts AS (SELECT NAME, CLASS, [" + ", ".join(f"CASE WHEN hi_{c} = lo_{c} THEN 0.0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END" for c in _F64) +
                          "] AS x FROM features_small, st)", _smote_ctes("pts", 5, 1),
                          "ed AS (SELECT a.NAME AS id, b.CLASS = a.CLASS AS same, row_number() OVER (PARTITION BY a.NAME ORDER BY "
                          "list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), b.NAME) AS rank "
                          "FROM smoted a, smoted b WHERE a.NAME <> b.NAME)",
                          "gone AS (SELECT DISTINCT id FROM ed WHERE rank <= 3 AND NOT same)") +
       f"SELECT NAME, CLASS, {_UNPACK} FROM smoted WHERE NAME NOT IN (SELECT id FROM gone)")
def q_smote_enn(spark, d):
    from motifspark.operators.knn import smote_enn
    return _round_cols(smote_enn(V.features_small(spark, d), _F64, 5, 3, seed=1), _F64)


@query("knn_ties", _with(O.features_small_cte(),
                         "pts AS (SELECT NAME, [round(f0, 0), round(f1, 0), round(f2, 0)] AS x FROM features_small)",
                         "r AS (SELECT a.NAME AS id, b.NAME AS nid, sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist, "
                         "row_number() OVER (PARTITION BY a.NAME ORDER BY list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), b.NAME) AS rank "
                         "FROM pts a, pts b WHERE a.NAME <> b.NAME)") +
       "SELECT id, nid, round(dist, 6) AS dist, rank FROM r WHERE rank <= 5")
def q_knn_ties(spark, d):
    """Many equal points; the plan by pivot cells."""
    from motifspark.operators.knn import knn
    p = V.features_small(spark, d).select("NAME", F.array(*[F.round(f"f{i}", 0) for i in range(3)]).alias("x"))
    return knn(p, 5, block_rows=128, broadcast_bytes=0).select("id", "nid", r6(F.col("dist")).alias("dist"), "rank")


# ---------------------------------------------------------------- learning (L3-L7, L11, L17): rows checks

def _labelled_small(spark, d):
    return V.features_small(spark, d)


@query("train_logreg")
def q_train_logreg(spark, d):
    from motifspark.operators.train import coefficient_table, fit_linear
    row = fit_linear(_labelled_small(spark, d), _F64, "logreg", {"C": 1.0}, list_id="logreg")
    return coefficient_table(spark, [row])


@query("train_sgd")
def q_train_sgd(spark, d):
    from motifspark.operators.train import coefficient_table, fit_linear_trio
    rows = fit_linear_trio(_labelled_small(spark, d), _F64, "linear/f1/PTM/1x/feats64",
                           {"logreg": {"C": 1.0}, "sgd": {"alpha": 1e-4, "penalty": "elasticnet", "l1_ratio": 0.15}})
    return coefficient_table(spark, rows)


@query("train_partial")
def q_train_partial(spark, d):
    """By epochs of SGD, and by one pass over ten batches, each fitted on from the one before."""
    from motifspark.operators.stacked import fit_partial_many, fit_sgd_many
    from motifspark.operators.train import coefficient_table, prepared
    wanted = [("sgd", {"alpha": a, "penalty": p}) for a in (1e-3, 1e-2) for p in ("l2", "elasticnet")]
    with prepared(_labelled_small(spark, d), _F64) as ready:
        fits = {"sgd": fit_sgd_many(ready, wanted), "sgd_partial": fit_partial_many(ready, wanted)}
    return coefficient_table(spark, [{"list_id": f"{kind}/{q['penalty']}/{q['alpha']}", **row} for kind, found in fits.items() for (_, q), row in zip(wanted, found)])


@query("train_mlp")
def q_train_mlp(spark, d):
    """L6/L17 with the default layout: the names that the fitted perceptron predicts."""
    from motifspark.operators.train import predict_mlp, train_mlp
    df = _labelled_small(spark, d)
    return predict_mlp(train_mlp(df, _F64), df)


@query("feature_importance")
def q_importance(spark, d):
    return IM.feature_importance(_labelled_small(spark, d), _F64, n_trees=500, seed=0)


@query("search_linear")
def q_search(spark, d):
    from motifspark.operators.search import best_per_model, search_linear
    return best_per_model(search_linear(_labelled_small(spark, d), _F64, seed=0))


@query("search_nn")
def q_search_nn(spark, d):
    from motifspark.operators.search import best_per_model, search_mlp
    return best_per_model(search_mlp(_labelled_small(spark, d), _F64, seed=0), {"f1": "f1"})


@query("search_smoteenn")
def q_search_smoteenn(spark, d):
    from motifspark.operators.search import search_resampled
    return search_resampled(_labelled_small(spark, d), _F64, seed=0)


@query("predict_smoteenn")
def q_predict_smoteenn(spark, d):
    """Lists of the resampled models of one tag and feature set, over an ingested feature table."""
    from motifspark.operators.predict import Models, prediction_pairs, score_features
    from motifspark.plans.pipeline import PipelineConfig, resampled_models, train_resampled
    from motifspark.operators.train import coefficient_table
    table, cfg = _labelled_small(spark, d), PipelineConfig()
    rows = train_resampled(table, _F64, "smoteenn/PTM/cum90", lambda k: cfg.params[k], cfg)
    mine = resampled_models(coefficient_table(spark, rows), "PTM", "cum90").collect()   # three rows
    models = Models.of([r.asDict() for r in mine], [], _F64)
    return prediction_pairs(score_features(table, models, _F64, ["NAME"], least=1), models)


# ---------------------------------------------------------------- ingested tables and repeated IDs

@query("scoring_matrix", _with(O.features_dirty_cte()) +
       "SELECT NAME, " + _sql_round(_F64, "CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 ELSE {c} END") + " FROM features_dirty")
def q_scoring_matrix(spark, d):
    from motifspark.plans.pipeline import ingest_features
    return _round_cols(ingest_features(V.features_dirty(spark, d)).drop("CLASS"), _F64)


_DUP_SQL = _with(O.sequences_cte().replace("sequences AS", "docseq AS", 1),
                 f"bseq AS (SELECT 'D' || CAST(item_id AS VARCHAR) AS seq_id, upper(regexp_replace(text, '{O.NOT_RES}', '', 'g')) AS seq FROM benchmark)",
                 "sequences AS (SELECT seq_id, seq FROM docseq UNION ALL SELECT seq_id, seq FROM bseq)",
                 O.windows_cte(), O.features_big_cte(), O.models_cte(),
                 f"hit AS (SELECT DISTINCT f.NAME AS name, m.list_id FROM features_big f, models m WHERE {O.margin_expr()} <= 0)",
                 "support AS (SELECT name, count(*) AS support FROM hit GROUP BY name)",
                 "nl AS (SELECT count(DISTINCT list_id) AS n FROM hit)", "th AS (SELECT unnest([100, 95, 90, 85]) AS pct)")


@query("consensus_duplicates", _DUP_SQL + "SELECT th.pct, s.name, s.support FROM support s, th, nl "
       "WHERE s.support >= ceil(CAST(th.pct AS DOUBLE) / 100.0 * CAST(nl.n AS DOUBLE))")
def q_consensus_duplicates(spark, d):
    """Documents and benchmark passages under shared IDs: every name votes once per model."""
    seqs = V.sequences(spark, d).select("seq_id", "seq").unionByName(_bench_as_docs(spark, d).select("seq_id", "seq"))
    return flows.consensus_windows(flows.window_scores(seqs, V.models_linear(spark))).select("pct", "name", "support")


@query("control_pools", _REF + ", rnd AS (SELECT NAME FROM features_big WHERE split_part(NAME, ':', 1) NOT IN (SELECT id FROM id_list) "
       "ORDER BY md5('5:' || NAME), NAME LIMIT 100000) "
       "SELECT 'PTM' AS tag, NAME FROM features_big WHERE split_part(NAME, ':', 1) IN (SELECT id FROM id_list) UNION ALL SELECT 'Random', NAME FROM rnd")
def q_control_pools(spark, d):
    """both pools; the random one is drawn with a fixed n."""
    seqs, ids = V.sequences(spark, d), V.id_list(spark, d)
    ptm = _names(CO.sequences_by_ids(seqs, ids)).select(F.lit("PTM").alias("tag"), "NAME")
    rnd = CO.random_controls(_names(CO.sequences_by_ids(seqs, ids, exclude=True)), 100_000, 5)
    return ptm.unionByName(rnd.select(F.lit("Random").alias("tag"), "NAME"))


# ---------------------------------------------------------------- run plans, grids and the parameter cache

_TAGS_SQL = "tags AS (SELECT DISTINCT coalesce(source, 'none') AS tag FROM documents)"
_KEYS_SQL = _with(_TAGS_SQL, "langs AS (SELECT coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS tag, count(*) AS n FROM documents GROUP BY ALL)",
                  "plan AS (SELECT 'linear' AS family, lang AS crit, tag, m AS mult, 69 AS n_feats, 'sgd' AS model FROM (SELECT DISTINCT lang FROM langs), tags, (SELECT unnest([1, 2]) AS m))",
                  "cache AS (SELECT 'linear' AS family, lang AS crit, tag, 1 AS mult, 69 AS n_feats, 'sgd' AS model, CAST(n AS VARCHAR) AS params FROM langs)")
_KEY_COLS = "family, crit, tag, mult, n_feats, model"


def _plan_and_cache(spark, d):
    """A plan over the languages and sources of the documents, and a cache with an entry for those that occur together."""
    docs = V.table(spark, d, "documents").select(F.coalesce("lang", F.lit("none")).alias("crit"), F.coalesce("source", F.lit("none")).alias("tag"))
    there = docs.groupBy("crit", "tag").count()
    keys = lambda df, mult: df.select(F.lit("linear").alias("family"), "crit", "tag", mult.alias("mult"), F.lit(69).alias("n_feats"), F.lit("sgd").alias("model"), *[c for c in df.columns if c == "params"])
    pairs = docs.select("crit").distinct().crossJoin(docs.select("tag").distinct())   # languages x sources
    return keys(pairs, F.explode(F.array(F.lit(1), F.lit(2)))), keys(there.withColumn("params", F.col("count").cast("string")), F.lit(1))


@query("hparam_pending", _KEYS_SQL + f"SELECT {_KEY_COLS} FROM plan WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.crit = plan.crit AND c.tag = plan.tag AND c.mult = plan.mult)")
def q_hparam_pending(spark, d):
    from motifspark.operators.search import pending
    return pending(*_plan_and_cache(spark, d)).select(*_KEY_COLS.split(", "))


@query("hparam_lookup", _KEYS_SQL + f"SELECT {_KEY_COLS}, params FROM plan JOIN cache USING ({_KEY_COLS})")
def q_hparam_lookup(spark, d):
    """J5 for the plan rows that are in the cache; one that is not would be an error."""
    from motifspark.operators.search import CACHE_KEYS, lookup, pending
    plan, cache = _plan_and_cache(spark, d)
    known = plan.join(pending(plan, cache), CACHE_KEYS, "left_anti")
    return lookup(known, cache).select(*_KEY_COLS.split(", "), "params")


@query("run_plan", _with(_TAGS_SQL, "crits AS (SELECT unnest(['f1', 'max_recall', 'fbeta']) AS crit)", "mults AS (SELECT unnest([1, 2, 5, 10]) AS mult)",
                         "feats AS (SELECT unnest([69, 126]) AS n_feats)", "models AS (SELECT unnest(['sgd', 'logreg', 'sgd_partial']) AS model)") +
       "SELECT 'linear' AS family, crit, tag, mult, n_feats, model, 'linear/' || crit || '/' || tag || '/' || mult || 'x/feats' || n_feats || '/' || model AS list_id FROM crits, tags, mults, feats, models UNION ALL "
       "SELECT 'nn', 'f1', tag, mult, n_feats, 'mlp', 'nn/' || tag || '/' || mult || 'x/feats' || n_feats || '/mlp' FROM tags, mults, feats UNION ALL "
       "SELECT 'smoteenn', 'f1', tag, 0, n_feats, model, 'smoteenn/' || tag || '/feats' || n_feats || '/' || model FROM tags, feats, models")
def q_run_plan(spark, d):
    """J6 with the sources of the documents as tags."""
    from motifspark.plans.runplan import RunDims, run_plan
    tags = V.table(spark, d, "documents").select(F.coalesce("source", F.lit("none"))).distinct().collect()   # run dimensions are configuration
    return run_plan(spark, RunDims(tags=sorted(r[0] for r in tags)))


@query("param_grid", _with("c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)", "al AS (SELECT unnest([1e-5, 1e-4, 1e-3]) AS alpha, unnest([0, 1, 2]) AS a)",
                           "pr AS (SELECT unnest(['l2', 'elasticnet', 'elasticnet']) AS penalty, unnest([0.0, 0.15, 0.5]) AS l1_ratio, unnest([0, 1, 2]) AS p)") +
       "SELECT CAST(9 + 3 * a + p AS INTEGER) AS grid_ord, 'sgd' AS model, CAST(alpha AS DOUBLE) AS alpha, penalty, CAST(l1_ratio AS DOUBLE) AS l1_ratio, quality, n FROM al, pr, c")
def q_param_grid(spark, d):
    """The SGD half of the linear grid for every class of the labels."""
    from motifspark.operators.search import grid_table, linear_grid
    classes = V.table(spark, d, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    grid = grid_table(spark, linear_grid()).where("model = 'sgd'").withColumn("p", F.from_json("params", "alpha double, penalty string, l1_ratio double"))
    return grid.crossJoin(classes).select("grid_ord", "model", "p.alpha", "p.penalty", "p.l1_ratio", "quality", "n")   # 9 rows x classes


@query("set_names", "SELECT DISTINCT CAST(l_discount + l_tax AS DOUBLE) AS threshold, 'cum' || CAST(trunc(CAST(l_discount + l_tax AS DOUBLE) * 100) AS INTEGER) AS name, "
       "CASE WHEN CAST(l_linenumber AS INTEGER) = 1 THEN '' ELSE CAST(CAST(l_linenumber AS INTEGER) AS VARCHAR) END AS suffix FROM lineitem")
def q_set_names(spark, d):
    """X11 for every share and multiple among the line items."""
    rows = V.table(spark, d, "lineitem").select((F.col("l_discount") + F.col("l_tax")).cast("double").alias("threshold"), F.col("l_linenumber").cast("int").alias("m")).distinct()
    return rows.select("threshold", IM.set_name_of(F.col("threshold")).alias("name"), IM.bucket_suffix_of(F.col("m")).alias("suffix"))


@query("fragment_pipeline")
def q_pipeline(spark, d):
    """F8 end to end on the test tables: benchmark passages are the known fragments, documents the reference,
    labels.quality = 0 the ID list; all tags and multiples, linear models and perceptrons with default parameters, the
    default vote thresholds and a majority of half the lists beside them."""
    from motifspark.plans.pipeline import PipelineConfig, run
    cfg = PipelineConfig(families=("linear", "nn"), thresholds=(100, 95, 90, 85, 50))
    out = run(spark, cfg, V.benchmark_sequences(spark, d), V.sequences(spark, d), V.id_list(spark, d))
    return out["fasta"].select("pct", "seq_id", "start", "end", "n_frags", "record")
