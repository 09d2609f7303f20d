"""Fixture views over the driver tables (FIXTURES.md part 3).

Each view is one SELECT with ``{table}`` placeholders.  Spark binds the
placeholders to DataFrames (``spark.sql(text, orders=df)``) so the view is an
ordinary lazy plan; the DuckDB oracle inlines the same text as a CTE with the
placeholders replaced by the pre-registered view names.  Money stays DECIMAL
so that both engines produce the same digits.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from custos.sources.tables import scan

# The name lists below are the fixture definition (FIXTURES.md).
_FIRST = "ann,bob,carla,david,erin,frank,grace,henry,irene,jacob"
_LAST = "smith,johnson,williams,brown,jones,garcia,miller,davis,martinez,lopez,wilson"
_CITY = "austin,boston,chicago,denver,elgin"
_STATE = "tx,ma,il,co,il"

_PEOPLE_BASE = f"""SELECT c_custkey AS k,
 split_part('{_FIRST}', ',', cast(c_custkey % 10 AS integer)+1) AS fn,
 split_part('{_LAST}', ',', cast(c_custkey % 11 AS integer)+1) AS ln,
 concat(cast(100 + c_custkey % 900 AS varchar(20)), ' Main-St. (apt ', cast(c_custkey % 7 AS varchar(20)), ')') AS addr,
 split_part('{_CITY}', ',', cast(c_custkey % 5 AS integer)+1) AS city,
 split_part('{_STATE}', ',', cast(c_custkey % 5 AS integer)+1) AS st,
 concat(cast(10000 + c_custkey % 89 AS varchar(20)), '-0001') AS zip,
 concat('(555) ', cast(1000000 + c_custkey AS varchar(20))) AS ph FROM {{customer}}"""

VIEWS: dict[str, str] = {
    "transactions": """SELECT o_custkey AS customer_id, concat('c', cast(o_custkey as varchar(20)), '@Mail.test') AS email,
 cast(o_orderdate AS date) AS order_date, cast(o_totalprice AS decimal(18,2)) AS product_amount FROM {orders}""",
    "order_line_revenue": """SELECT l_orderkey AS order_id, cast(o_orderdate AS date) AS order_date, l_partkey AS sku, o_custkey AS unique_customer_id,
 cast(l_extendedprice AS decimal(18,2)) AS product_price, cast(l_extendedprice AS decimal(18,2))*cast(l_discount AS decimal(4,2)) AS product_discount_amount,
 cast(l_extendedprice AS decimal(18,2))*cast(l_discount AS decimal(4,2)) AS discount_amount, cast(l_extendedprice AS decimal(18,2))*cast(l_tax AS decimal(4,2)) AS shipping_amount,
 CASE WHEN l_returnflag='R' THEN cast(l_extendedprice AS decimal(18,2)) ELSE cast(0 AS decimal(18,2)) END AS refund_amount,
 cast(l_extendedprice AS decimal(18,2)) - cast(l_extendedprice AS decimal(18,2))*cast(l_discount AS decimal(4,2)) AS gross_margin,
 cast(l_quantity AS integer) AS num_units, CASE WHEN o_orderstatus='P' THEN 0 ELSE 1 END AS valid_order_flag
 FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey""",
    "sku_attributes": "SELECT p_partkey AS sku, p_type AS product_type FROM {part}",
    "customer_profiles": """SELECT f.o_custkey AS unique_customer_id, max(CASE WHEN rf=1 THEN o_orderkey END) AS first_order_id,
 max(CASE WHEN rl=1 THEN o_orderkey END) AS last_order_id, max(CASE WHEN rl=1 THEN cast(o_orderdate AS date) END) AS last_order_date,
 max(CASE WHEN rf=1 THEN o_orderpriority END) AS first_order_fc_channel, max(CASE WHEN rf=1 THEN o_orderstatus END) AS first_order_fc_vendor,
 sum(cast(o_totalprice AS decimal(18,2))) AS gross_margin, count(*) AS num_orders
 FROM (SELECT o.*, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rf,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rl FROM {orders} o) f GROUP BY f.o_custkey""",
    "daily_pair": """SELECT cast(o_orderdate AS date) AS dt, sum(CASE WHEN o_custkey % 2 = 0 THEN cast(o_totalprice AS decimal(18,2)) ELSE 0 END) AS river,
 sum(CASE WHEN o_custkey % 2 = 1 THEN cast(o_totalprice AS decimal(18,2)) ELSE 0 END) AS off_river FROM {orders} GROUP BY cast(o_orderdate AS date)""",
    "monthly_sales": """SELECT cast(date_trunc('month', l_shipdate) AS date) AS month, sum(cast(l_extendedprice AS decimal(18,2))) AS sales,
 avg(l_quantity) AS intent, sum(cast(l_extendedprice AS decimal(18,2))*cast(l_tax AS decimal(4,2))) AS spend FROM {lineitem} GROUP BY 1""",
    "people": f"""SELECT k AS customer_id, CASE WHEN k % 13 = 0 THEN ' ' ELSE concat(fn, cast(k AS varchar(20)), '@mail.test') END AS email, fn AS first_name, ln AS last_name,
 ph AS phone, addr AS address, city, st AS state, zip, '0' AS new_recs FROM ({_PEOPLE_BASE}) b
 UNION ALL SELECT 1000000 + k, concat(fn, cast(k AS varchar(20)), CASE WHEN k % 20 = 0 THEN '@mail.test' ELSE '@mail2.test' END), upper(fn), concat(ln, CASE WHEN k % 30 = 0 THEN 'e' ELSE '' END),
 ph, addr, city, st, zip, '1' FROM ({_PEOPLE_BASE}) b2 WHERE k % 10 = 0""",
    "survey": """SELECT l_orderkey * 1000 + l_linenumber AS resp_id, cast(l_quantity AS decimal(10,2)) AS q4, cast(l_extendedprice AS decimal(18,2)) AS q5,
 cast(l_discount AS decimal(4,2)) AS q6, cast(l_tax AS decimal(4,2)) AS q7, p_size AS q8, p_type AS dept, p_brand AS vert,
 l_returnflag AS ds_role, l_linestatus AS orig_clust FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "credit": """SELECT o_orderkey AS id, CASE WHEN o_totalprice + 20000 * (o_custkey % 7) > 300000 THEN 1 ELSE 0 END AS credit_appl,
 CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS pred, cast(floor(o_totalprice / 10000) AS integer) AS score,
 cast(o_custkey % 4 AS integer) AS account_balance, cast(substring(o_orderpriority, 1, 1) AS integer) AS purpose FROM {orders}""",
    "samples": """SELECT cast(floor(event_id / 3) AS integer) AS sample_id, cast(event_id % 3 + 1 AS integer) AS step, cast(value AS decimal(18,2)) AS value FROM {events}""",
    "chat_strings": """SELECT conv_id, CASE WHEN turn % 2 = 0 THEN concat('Human: ', text, '<split>') ELSE concat('ChatBot: ', text, '<split>') END AS piece, turn FROM {conversations} WHERE role <> 'system'""",
    "entity_lookup": """SELECT c_custkey AS customer_id, concat('c', cast(c_custkey AS varchar(20)), '@mail.test') AS email, cast('2020-06-15 13:15:00' AS timestamp) AS ts FROM {customer} WHERE c_custkey % 4 <> 0""",
    "event_daily": """SELECT event_type AS series_id, cast(ts AS date) AS dt, sum(cast(value AS decimal(18,2))) AS value, count(*) AS n FROM {events} GROUP BY event_type, cast(ts AS date)""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def view_tables(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(VIEWS[name])))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture view as a lazy DataFrame over the parquet scans."""
    text = VIEWS[name]
    return spark.sql(text, **{t: scan(spark, sf_dir, t) for t in view_tables(name)})


def view_sql(name: str) -> str:
    """The same view for DuckDB: placeholders become the registered table names."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[name])


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the fixture views it uses as CTEs (oracle side).

    ``body`` may itself start with ``WITH`` (its CTEs are appended) or with a
    comma-led CTE continuation.
    """
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({view_sql(n)})" for n in names)
    rest = body.lstrip()
    if rest[:5].upper() == "WITH ":
        rest = ",\n" + rest[5:]
    elif not rest.startswith(","):
        rest = "\n" + rest
    return f"WITH {ctes}{rest}"
