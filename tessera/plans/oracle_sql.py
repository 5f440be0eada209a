"""DuckDB SQL twins of the registered queries (the correctness oracle).

Tables are the driver's pre-registered views.  The analysis chain is
rendered from the same constants and Porter rules as the Spark side
(:mod:`tessera.functions.text`, :mod:`tessera.functions.porter`), so the
oracle checks the Spark plans (joins, aggregations, windows, top-k), not a
second copy of hand-typed rules.
"""

from __future__ import annotations

from tessera.functions import text as tx


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def index_ctes(p: str, source_sql: str, id_col: str = "doc_id", text_col: str = "text",
               stop: bool = True, stem: bool = True, fold: bool = True) -> list[str]:
    """CTEs ``{p}_tok, {p}_tf, {p}_df, {p}_idf, {p}_post`` (+ ``{p}_docs``)."""
    ctes = [f"{p}_docs AS ({source_sql})"]
    tctes, _ = tx.sql_tokens_ctes(f"{p}_tok", f"SELECT {id_col}, {text_col} FROM {p}_docs",
                                  id_col, text_col, stop=stop, stem=stem, do_fold=fold)
    ctes += tctes
    ctes += [
        f"{p}_tf AS (SELECT {id_col}, term, count(*)::BIGINT AS tf FROM {p}_tok GROUP BY ALL)",
        f"{p}_df AS (SELECT term, count(*)::BIGINT AS df FROM {p}_tf GROUP BY term)",
        f"{p}_idf AS (SELECT term, df, log10((SELECT count(*) FROM {p}_docs)::DOUBLE / df) AS idf "
        f"FROM {p}_df)",
        f"{p}_w AS (SELECT t.term, t.{id_col}, t.tf, t.tf * i.idf AS w FROM {p}_tf t "
        f"JOIN {p}_idf i USING (term))",
        f"{p}_norm AS (SELECT {id_col}, sqrt(sum(w * w)) AS norm FROM {p}_w GROUP BY {id_col})",
        f"{p}_post AS (SELECT w.term, w.{id_col}, w.tf, w.w, "
        f"CASE WHEN n.norm = 0 THEN NULL ELSE w.w / n.norm END AS wn, n.norm "
        f"FROM {p}_w w JOIN {p}_norm n USING ({id_col}))",
    ]
    return ctes


def query_ctes(p: str, ix: str, source_sql: str, qid: str = "qid", text_col: str = "text",
               stop: bool = True, stem: bool = True, fold: bool = True) -> list[str]:
    """CTEs ``{p}_all`` (distinct terms) and ``{p}_vec`` (qid, term, qtf, qw, qnorm, qwn)."""
    tctes, _ = tx.sql_tokens_ctes(f"{p}_tok", source_sql, qid, text_col,
                                  stop=stop, stem=stem, do_fold=fold)
    return tctes + [
        f"{p}_all AS (SELECT DISTINCT {qid}, term FROM {p}_tok)",
        f"{p}_tf AS (SELECT {qid}, term, count(*)::BIGINT AS qtf FROM {p}_tok GROUP BY ALL)",
        f"{p}_w AS (SELECT t.{qid}, t.term, t.qtf, t.qtf * i.idf AS qw FROM {p}_tf t "
        f"JOIN {ix}_idf i USING (term))",
        f"{p}_vec AS (SELECT *, CASE WHEN qnorm = 0 THEN NULL ELSE qw / qnorm END AS qwn FROM "
        f"(SELECT *, sqrt(sum(qw * qw) OVER (PARTITION BY {qid})) AS qnorm FROM {p}_w))",
    ]


def literal_query_sql(text: str, qid: str = "qid", text_col: str = "text") -> str:
    return f"SELECT 0::BIGINT AS {qid}, {q(text)} AS {text_col}"


def cosine_ctes(p: str, ix: str, qp: str, qid: str, id_col: str = "doc_id") -> list[str]:
    return [f"{p} AS (SELECT {qid}, {id_col}, sum(v.qwn * d.wn) AS score "
            f"FROM {ix}_post d JOIN {qp}_vec v USING (term) GROUP BY {qid}, {id_col} "
            f"HAVING sum(v.qwn * d.wn) IS NOT NULL)"]


def top_k_sql(src: str, k: int, qid: str, id_col: str = "doc_id") -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {qid} "
            f"ORDER BY round(score, 12) DESC, {id_col} ASC)::BIGINT AS rank FROM {src}) WHERE rank <= {k}")
