"""Registry of runnable queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Row changes of the orders table, as SQL that Spark and DuckDB both run.
CHG = """
WITH o AS (SELECT o_orderkey k, o_orderstatus st, o_totalprice p, o_orderpriority pr, o_orderdate od FROM orders),
e AS (
 SELECT 10000000+k AS scn, 'INSERT' AS dml, CAST(NULL AS BIGINT) b_k, CAST(NULL AS STRING) b_st, CAST(NULL AS DOUBLE) b_p, CAST(NULL AS STRING) b_pr,
        k a_k, st a_st, p a_p, pr a_pr, 'k,st,p,pr' present, k ok, od FROM o
 UNION ALL SELECT 20000000+k,'UPDATE',k,st,p,pr,NULL,NULL,p+1,NULL,'p',k,od FROM o WHERE k%3=0
 UNION ALL SELECT 30000000+k,'UPDATE',k,st,p+CASE WHEN k%3=0 THEN 1 ELSE 0 END,pr,NULL,NULL,NULL,NULL,'pr',k,od FROM o WHERE k%5=0
 UNION ALL SELECT 40000000+k,'UPDATE',k,st,p+CASE WHEN k%3=0 THEN 1 ELSE 0 END,CASE WHEN k%5=0 THEN NULL ELSE pr END,
        k+10000000,NULL,NULL,NULL,'k',k,od FROM o WHERE k%11=0
 UNION ALL SELECT 50000000+k,'DELETE',CASE WHEN k%11=0 THEN k+10000000 ELSE k END,st,p+CASE WHEN k%3=0 THEN 1 ELSE 0 END,
        CASE WHEN k%5=0 THEN NULL ELSE pr END,NULL,NULL,NULL,NULL,'',k,od FROM o WHERE k%7=0),
chg1 AS (SELECT e.*, CAST(FLOOR(scn/100) AS BIGINT) tx_no, CAST(ok%3+1 AS INT) redo_thread FROM e),
chg AS (SELECT chg1.*, 0 redelivery FROM chg1 UNION ALL SELECT chg1.*, 1 FROM chg1 WHERE scn%13=0),
-- complete after-images
img AS (SELECT scn, dml, ok, od, tx_no, redo_thread, redelivery, b_k, b_st, b_p, b_pr,
  CASE WHEN dml='DELETE' THEN NULL WHEN dml='INSERT' OR scn-ok=40000000 THEN a_k ELSE b_k END f_k,
  CASE WHEN dml='DELETE' THEN NULL WHEN dml='INSERT' THEN a_st ELSE b_st END f_st,
  CASE WHEN dml='DELETE' THEN NULL WHEN dml='INSERT' OR scn-ok=20000000 THEN a_p ELSE b_p END f_p,
  CASE WHEN dml='DELETE' THEN NULL WHEN dml='INSERT' OR scn-ok=30000000 THEN a_pr ELSE b_pr END f_pr FROM chg)
"""

STATE = """SELECT CASE WHEN o_orderkey%11=0 THEN o_orderkey+10000000 ELSE o_orderkey END AS k, o_orderstatus AS st,
 o_totalprice+CASE WHEN o_orderkey%3=0 THEN 1 ELSE 0 END AS p, CASE WHEN o_orderkey%5=0 THEN NULL ELSE o_orderpriority END AS pr
 FROM orders WHERE o_orderkey%7<>0"""


def state_at(scn: int) -> str:
    """Closed-form content of the orders table as of an SCN."""
    return f"""SELECT CASE WHEN o_orderkey%11=0 AND {scn} >= 40000000+o_orderkey THEN o_orderkey+10000000 ELSE o_orderkey END AS k,
 o_orderstatus AS st,
 o_totalprice+CASE WHEN o_orderkey%3=0 AND {scn} >= 20000000+o_orderkey THEN 1 ELSE 0 END AS p,
 CASE WHEN o_orderkey%5=0 AND {scn} >= 30000000+o_orderkey THEN NULL ELSE o_orderpriority END AS pr
 FROM orders WHERE {scn} >= 10000000+o_orderkey AND NOT (o_orderkey%7=0 AND {scn} >= 50000000+o_orderkey)"""
