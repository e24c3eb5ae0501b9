"""Input views over the given tables for the registered queries.

Every text is valid both in Spark SQL and in DuckDB; ``<name>`` stands for a table
or another view. All views work row by row: none joins, groups or ranks, so that a
query's cost is the cost of its operator.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketlake.schemas import ACTION_ELEMENT
from docketlake.session import configure
from docketlake.sources.files import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "s_actions": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS digest_date,
          CASE o_orderstatus WHEN 'F' THEN 'administrative' WHEN 'O' THEN 'civil' ELSE 'criminal' END
            AS action_type,
          o_orderpriority AS title,
          CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS settlement,
          concat('34-', CAST(o_orderkey AS VARCHAR(20))) AS release_number
        FROM <orders>""",
    "s_respondents": """
        SELECT o_orderkey * 2 AS id, o_orderkey AS action_id,
          concat('Customer ', CAST(o_custkey AS VARCHAR(20))) AS name,
          CASE o_custkey % 5 WHEN 0 THEN 'individual' WHEN 1 THEN 'company' WHEN 2 THEN 'broker-dealer'
            WHEN 3 THEN 'other' END AS entity_type,
          concat('District ', CAST(o_custkey % 25 AS VARCHAR(20))) AS location
        FROM <orders>""",
    "s_violations": """
        SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS action_id,
          CASE WHEN l_linenumber % 4 = 0 THEN NULL
            ELSE concat('Section ', CAST(l_partkey % 997 AS VARCHAR(20))) END AS statute,
          l_returnflag AS description
        FROM <lineitem>""",
    "s_sanctions": """
        SELECT l_orderkey * 8 + l_linenumber AS id,
          CASE WHEN l_suppkey % 50 = 7 THEN -l_orderkey ELSE l_orderkey END AS action_id,
          CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'cease_and_desist'
            WHEN l_returnflag = 'R' THEN 'fine' WHEN l_linestatus = 'O' THEN 'order-to-pay'
            ELSE 'suspension' END AS sanction_type,
          l_linestatus AS description, CAST(NULL AS VARCHAR(20)) AS duration,
          CAST(l_linenumber AS VARCHAR(20)) AS amount
        FROM <lineitem>""",
    "s_manifest": """
        SELECT event_id, concat('u/', CAST(event_id AS VARCHAR(20))) AS url,
          CAST(1956 + user_id % 59 AS INT) AS year, CAST(ts AS DATE) AS date,
          concat('raw/', CAST(event_id AS VARCHAR(20)), '.htm') AS local_path,
          CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'skipped'
            WHEN 'error' THEN 'failed' WHEN 'click' THEN 'pending' ELSE 'completed' END AS download_status,
          CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN event_id % 5000 END AS file_size_bytes,
          CASE WHEN event_type IN ('purchase', 'view', 'signup') THEN ts END AS downloaded_at,
          CASE WHEN event_type = 'error' THEN
            CASE event_id % 2 WHEN 0 THEN 'HTTP 503' ELSE '404 Not Found (likely weekend/holiday)' END
          END AS error_message
        FROM <events>""",
    "s_parsing": """
        SELECT event_id,
          CASE WHEN event_id % 10 = 0 THEN concat('lost/', CAST(event_id AS VARCHAR(20)), '.htm')
            ELSE concat('raw/', CAST(event_id AS VARCHAR(20)), '.htm') END AS pdf_path,
          concat('markdown/', CAST(event_id AS VARCHAR(20)), '.md') AS markdown_path,
          CASE WHEN event_type NOT IN ('purchase', 'view', 'signup') THEN 'failed' ELSE
            CASE event_id % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' ELSE 'completed' END END AS parsing_status,
          CASE WHEN event_id % 7 > 1 THEN CAST(event_id % 9 AS INT) END AS page_count,
          CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 4001 AS INT) END AS markdown_length,
          CASE WHEN event_id % 7 > 1 THEN ts END AS parsed_at,
          CASE WHEN event_id % 7 = 0 THEN 'broken' END AS error_message
        FROM <events>""",
    # Two candidates in each of three attempts for every work item.
    "s_attempts": """
        SELECT (event_id - event_id % 6) / 6 AS w6, event_id % 6 AS r6, event_type, event_id, ts
        FROM <events>""",
    "s_fetches": """
        SELECT CAST(w6 AS BIGINT) AS work_id, CAST((r6 - r6 % 2) / 2 AS INT) AS attempt,
          CAST(r6 % 2 + 1 AS INT) AS cand_rank,
          concat('u/', CAST(CAST(w6 AS BIGINT) AS VARCHAR(20)), '/1') AS primary_url,
          concat('u/', CAST(CAST(w6 AS BIGINT) AS VARCHAR(20)), '/', CAST(CAST(r6 % 2 + 1 AS INT) AS VARCHAR(20)))
            AS request_url,
          CASE event_type WHEN 'purchase' THEN 200 WHEN 'error' THEN 503 WHEN 'click' THEN NULL ELSE 404 END
            AS http_status,
          CASE WHEN event_type = 'click' THEN concat('timeout ', CAST(event_id AS VARCHAR(20))) END AS error,
          event_id AS bytes, ts AS fetched_at
        FROM <s_attempts>""",
    # One call in each of up to six tries.
    "s_calls": """
        SELECT CAST(w6 AS BIGINT) AS work_id, CAST(r6 AS INT) AS attempt,
          CASE event_type WHEN 'purchase' THEN 200 WHEN 'error' THEN 503 WHEN 'click' THEN 429
            WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 401 WHEN 1 THEN NULL ELSE 502 END ELSE 504 END
            AS http_status,
          CASE WHEN event_type = 'view' AND event_id % 4 = 1 THEN 'connection lost' END AS error,
          event_id % 5 <> 0 AS valid
        FROM <s_attempts>""",
    "s_days": """
        SELECT event_id, date_add(DATE '1956-01-01', CAST(event_id * 13 % 21550 AS INT)) AS date
        FROM <events>""",
    "s_digests": """
        SELECT doc_id, date_add(DATE '1956-01-02', CAST(doc_id * 17 % 20000 AS INT)) AS digest_date,
          CAST(year(date_add(DATE '1956-01-02', CAST(doc_id * 17 % 20000 AS INT))) AS INT) AS year,
          concat(
            CASE doc_id % 8 WHEN 0 THEN 'ADMINISTRATIVE PROCEEDINGS' WHEN 1 THEN 'C1V1L  PR0CEED1NGS'
              WHEN 2 THEN 'CR|MINAL PROCEEDINGS' WHEN 3 THEN 'civil fees and proceeds'
              ELSE 'HOLDINGS' END,
            chr(10), text, chr(10), 'a | b', chr(10),
            CASE doc_id % 3 WHEN 0 THEN 'administration of all proceeds and criminal proceedings' ELSE '' END
          ) AS text
        FROM <documents>""",
    "s_responses": """
        SELECT conv_id, turn,
          CASE (conv_id * 3 + turn) % 14
            WHEN 0 THEN concat('{"actions":[', a, '}]}')
            WHEN 1 THEN concat('```json', chr(10), '{"actions":[', a, ',"settlement":"yes"}]}', chr(10), '```')
            WHEN 2 THEN concat('<think>{"a":1}', chr(10), 'x</think> {"actions":[', a, '}]} done')
            WHEN 3 THEN '{"actions":[],"extraction_notes":"a } b"} tail'
            WHEN 4 THEN concat('<think>never closed {"actions":[', a, '}]}')
            WHEN 5 THEN concat('{"actions":[', a)
            WHEN 6 THEN '{"actions":null}'
            WHEN 7 THEN '[1]'
            WHEN 8 THEN concat('{"actions":[', a, '},7]}')
            WHEN 9 THEN concat('{"actions":[', a, ',"title":5}]}')
            WHEN 10 THEN concat('{"actions":[', a, '},', a, ',"respondents":[{"name":"A"},{"name":null}]}]}')
            WHEN 11 THEN concat('{"actions":[', a, ',"respondents":[{"name":"A","entity_type":null}],',
              '"sanctions":[{"sanction_type":"fine","amount":"$5"}],"settlement":0}],"extraction_notes":null}')
            WHEN 12 THEN text
            ELSE '{}' END AS response
        FROM (SELECT conv_id, turn, text,
                concat('{"action_type":"civil","full_text":"', replace(text, chr(10), concat(chr(92), 'n')), '"') AS a
              FROM <conversations>) t""",
    # One nested digest per order: its own columns, before the arrays are built.
    "s_nested_base": """
        SELECT o_orderkey AS k, o_custkey AS ck, o_orderpriority AS priority, o_orderstatus AS status,
          CAST(o_orderdate AS DATE) AS digest_date, CAST(year(o_orderdate) AS INT) AS year_dir,
          concat('digest_', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), '_',
            lpad(CAST(o_orderkey AS VARCHAR(20)), 15, '0')) AS file_name,
          o_orderkey % 11 <> 5 AS has_enforcement_actions,
          CASE WHEN o_orderkey % 5 = 0 THEN 'ocr noise' END AS extraction_notes
        FROM <orders>""",
}

_NAME = re.compile(r"<(\w+)>")
_KNOWN = set(TABLES) | set(VIEWS)


def _expand(sql: str, table) -> str:
    def put(m: re.Match) -> str:
        name = m.group(1)
        if name in VIEWS:
            return f"({_expand(VIEWS[name], table)})"
        return table(name) if name in _KNOWN else m.group(0)

    return _NAME.sub(put, sql)


# Inputs whose rows are costly to work on: whole texts.
_COSTLY = {"documents", "pages", "s_digests", "s_responses"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in _COSTLY else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input view as a DataFrame."""
    sql = _expand(VIEWS[name], lambda t: f"parquet.`{sf_dir}/{t}.parquet`")
    df = configure(spark).sql(sql)
    return spread(df) if name in _COSTLY else df


def oracle(sql: str) -> str:
    """A query text with the views spelled out, for DuckDB."""
    return _expand(sql, lambda t: t)


def nested_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested digest per order with zero to three actions and their children.

    The arrays are built from the row's own columns, so no group is collected.
    """
    base = spread(view(spark, sf_dir, "s_nested_base"))
    k, ck = F.col("k"), F.col("ck")

    def upto(n):
        """Array 0..n-1."""
        return F.filter(F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0))), lambda i: i < n)

    def text(c):
        return c.cast("string")

    def action(i):
        t = (k + i) % 3
        resp = F.transform(upto((k + i) % 3), lambda j: F.struct(
            F.concat(F.lit("Customer "), text(ck + j)).alias("name"),
            F.when((ck + j) % 4 == 0, "individual").when((ck + j) % 4 == 1, "company")
            .when((ck + j) % 4 == 2, "other").alias("entity_type"),
            F.concat(F.lit("District "), text(ck % 25)).alias("location")))
        viol = F.transform(upto((k + 2 * i) % 3), lambda j: F.struct(
            F.when((ck + j) % 4 != 0, F.concat(F.lit("Section "), text((ck + j) % 50))).alias("statute"),
            F.col("priority").alias("description")))
        sanc = F.transform(upto((k + i) % 2), lambda j: F.struct(
            F.when(ck % 2 == 0, "fine").otherwise("suspension").alias("sanction_type"),
            F.col("status").alias("description"),
            F.lit(None).cast("string").alias("duration"),
            F.concat(F.lit("$"), text(ck + i)).alias("amount")))
        return F.struct(
            F.when(t == 0, "administrative").when(t == 1, "civil").otherwise("criminal").alias("action_type"),
            F.col("priority").alias("title"), resp.alias("respondents"), viol.alias("violations"),
            sanc.alias("sanctions"),
            F.when((k + 2 * i) % 3 == 0, True).when((k + 2 * i) % 3 == 1, False).alias("settlement"),
            F.when(t != 0, F.concat(F.lit("District "), text(ck % 25))).alias("court"),
            text(ck).alias("case_number"),
            F.concat(F.lit("34-"), text(k), F.lit("-"), text(i)).alias("release_number"),
            F.concat_ws(" / ", "priority", "status", text(i)).alias("full_text"))

    actions = F.transform(upto(k % 4), action).cast(f"array<{ACTION_ELEMENT}>")
    return base.select("k", "year_dir", "file_name", "digest_date", "has_enforcement_actions",
                       actions.alias("actions"), "extraction_notes")


# The same nested digests, already flat, for DuckDB.
FLAT_ACTIONS = """
    SELECT *, (k + i) % 3 AS t,
      CASE (k + i) % 3 WHEN 0 THEN 'administrative' WHEN 1 THEN 'civil' ELSE 'criminal' END AS action_type,
      CASE (k + 2 * i) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS settlement,
      CASE WHEN (k + i) % 3 <> 0 THEN concat('District ', ck % 25) END AS court,
      CAST(ck AS VARCHAR) AS case_number, concat('34-', k, '-', i) AS release_number,
      concat(priority, ' / ', status, ' / ', i) AS full_text
    FROM (SELECT *, unnest(range(k % 4)) AS i FROM <s_nested_base>) b"""
FLAT_RESPONDENTS = f"""
    SELECT k, i, j, digest_date, has_enforcement_actions, file_name, concat('Customer ', ck + j) AS name,
      CASE (ck + j) % 4 WHEN 0 THEN 'individual' WHEN 1 THEN 'company' WHEN 2 THEN 'other' END AS entity_type,
      concat('District ', ck % 25) AS location
    FROM (SELECT *, unnest(range((k + i) % 3)) AS j FROM ({FLAT_ACTIONS}) a) r"""
FLAT_VIOLATIONS = f"""
    SELECT k, i, j, digest_date, has_enforcement_actions, file_name,
      CASE WHEN (ck + j) % 4 <> 0 THEN concat('Section ', (ck + j) % 50) END AS statute,
      priority AS description
    FROM (SELECT *, unnest(range((k + 2 * i) % 3)) AS j FROM ({FLAT_ACTIONS}) a) r"""
FLAT_SANCTIONS = f"""
    SELECT k, i, j, digest_date, has_enforcement_actions, file_name,
      CASE WHEN ck % 2 = 0 THEN 'fine' ELSE 'suspension' END AS sanction_type,
      status AS description, CAST(NULL AS VARCHAR) AS duration, concat('$', ck + i) AS amount
    FROM (SELECT *, unnest(range((k + i) % 2)) AS j FROM ({FLAT_ACTIONS}) a) r"""
