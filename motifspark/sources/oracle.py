"""DuckDB SQL twins of the domain views (used only as independent oracles).

These strings define, in plain SQL over the driver's tables, the same views as
``motifspark.sources.views``; the driver runs them next to our Spark queries.
"""

from __future__ import annotations

from motifspark.functions.text import RESIDUES
from motifspark.plans.runplan import model_ids

NOT_RES = "[^" + RESIDUES + RESIDUES.lower() + "]"


def h(expr: str) -> str:
    """First 8 hex digits of md5 as a signed BIGINT."""
    return f"CAST(CAST(('0x' || substr(md5({expr}), 1, 8)) AS UBIGINT) AS BIGINT)"


def sequences_cte() -> str:
    return ("sequences AS (SELECT 'D' || CAST(doc_id AS VARCHAR) AS seq_id, "
            f"upper(regexp_replace(text, '{NOT_RES}', '', 'g')) AS seq, 'documents' AS source FROM documents)")


def windows_cte(w: int = 15, step: int = 1, min_len: int = 15) -> str:
    return (f"windows AS (SELECT seq_id || ':' || CAST(st AS VARCHAR) AS name, seq_id, CAST(st AS INTEGER) AS start, "
            f"substr(seq, st, {w}) AS sub FROM (SELECT seq_id, seq, unnest(range(1, length(seq) - {w} + 2, {step})) AS st "
            f"FROM sequences WHERE length(seq) >= {max(w, min_len)}))")


def composition_exprs(col: str = "sub") -> list[str]:
    return [f"(length({col}) - length(replace({col}, '{a}', ''))) / CAST(length({col}) AS DOUBLE) AS f_{a}"
            for a in RESIDUES]


def features_big_cte() -> str:
    return "features_big AS (SELECT name AS NAME, seq_id, start, " + ", ".join(composition_exprs()) + " FROM windows)"


def models_cte() -> str:
    ids = ", ".join(f"('{r['list_id']}')" for r in model_ids())
    ws = []
    for i, _ in enumerate(RESIDUES):
        base = h("'base:%d'" % i)
        noise = h("list_id || ':%d'" % i)
        ws.append(f"(({base} % 1024) - 512) / 1024.0 + (({noise} % 256) - 128) / 1024.0 AS w{i}")
    bias = "((%s %% 256) - 128) / 1024.0 + %r AS b" % (h("list_id || ':bias'"), 1.0 / 2048)
    return f"models AS (SELECT list_id, {', '.join(ws)}, {bias} FROM (VALUES {ids}) t(list_id))"


def margin_expr(f: str = "f", m: str = "m") -> str:
    terms = " + ".join(f"{m}.w{i} * {f}.f_{a}" for i, a in enumerate(RESIDUES))
    return f"({m}.b + {terms})"


def features_small_cte() -> str:
    feats = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))
    return ("features_small AS (SELECT 'E' || CAST(vec_id % 50 AS VARCHAR) || ':' || CAST(vec_id + 1 AS VARCHAR) AS NAME, "
            f"{feats}, CASE WHEN label = 0 THEN 0 ELSE 1 END AS CLASS FROM embeddings)")


def features_dirty_cte() -> str:
    cols = []
    for i in range(64):
        k = f"((vec_id + {i}) % 7)"
        cols.append(f"CASE WHEN {k} = 0 THEN NULL WHEN {k} = 1 THEN CAST('NaN' AS DOUBLE) WHEN {k} = 2 THEN CAST('inf' AS DOUBLE) "
                    f"WHEN {k} = 3 THEN CAST('-inf' AS DOUBLE) ELSE CAST(embedding[{i + 1}] AS DOUBLE) END AS f{i}")
    return ("features_dirty AS (SELECT 'E' || CAST(vec_id % 50 AS VARCHAR) || ':' || CAST(vec_id + 1 AS VARCHAR) AS NAME, "
            f"{', '.join(cols)}, CASE WHEN label = 0 THEN 0 ELSE 1 END AS CLASS FROM embeddings)")


def votes_wide_cte() -> str:
    return ("votes_wide AS (SELECT 'L' || CAST(l_linenumber AS VARCHAR) AS list_id, 'P' || CAST(l_partkey // 50 AS VARCHAR) || ':' || "
            "CAST(l_partkey % 50 + 1 AS VARCHAR) AS name FROM lineitem)")


def id_list_cte() -> str:
    return "id_list AS (SELECT 'D' || CAST(doc_id AS VARCHAR) AS id FROM labels WHERE quality = 0)"


def benchmark_windows_cte(prefix: str = "B", w: int = 15) -> str:
    return (f"bseq AS (SELECT '{prefix}' || CAST(item_id AS VARCHAR) AS seq_id, "
            f"upper(regexp_replace(text, '{NOT_RES}', '', 'g')) AS seq FROM benchmark),\n"
            f"pos_windows AS (SELECT seq_id || ':' || CAST(st AS VARCHAR) AS name, seq_id, CAST(st AS INTEGER) AS start, "
            f"substr(seq, st, {w}) AS sub FROM (SELECT seq_id, seq, unnest(range(1, length(seq) - {w} + 2)) AS st "
            f"FROM bseq WHERE length(seq) >= {w}))")


def features_text_cte() -> str:
    return ("features_text AS (SELECT 'E' || CAST(vec_id AS VARCHAR) AS NAME, CAST(vec_id AS VARCHAR) AS t0, "
            "CASE vec_id % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE CAST(label AS VARCHAR) END AS t1, "
            "CASE WHEN vec_id % 4 = 2 THEN 'x' ELSE CAST(vec_id * 3 - 7 AS VARCHAR) END AS t2 FROM embeddings)")


def importance_cte() -> str:
    parts = [f"SELECT 'f{i}' AS feature, round(abs(avg(CASE WHEN CLASS = 0 THEN f{i} END) - "
             f"avg(CASE WHEN CLASS = 1 THEN f{i} END)), 9) AS importance FROM features_small" for i in range(64)]
    return "importance AS (" + " UNION ALL ".join(parts) + ")"


def candidates_cte() -> str:
    u = h("CAST(least(g, 5) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)") + " / 4294967296.0"
    return ("candidates AS (SELECT 'c' || CAST(g AS VARCHAR) AS cand, CAST(g AS INTEGER) AS grid_ord, "
            f"CAST(quality AS INTEGER) AS y_true, CASE WHEN {u} < CAST(least(g, 5) AS DOUBLE) / 5.0 THEN 1 ELSE 0 END AS y_pred "
            "FROM labels, (SELECT unnest(range(0, 7)) AS g) WHERE quality IS NOT NULL)")
