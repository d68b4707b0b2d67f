"""A longitudinal wide source derived from the TPC-H-like tables.

Baseline rows come from ``customer`` (one per participant, ``repeat_kind``
null) and repeat rows from ``orders`` (``repeat_kind = 'order'``). Codes,
flags, date texts and nulls are derived with integer arithmetic only, so the
DuckDB text of the same table (``WIDE_SQL``) builds identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER_COL = "row_ord"


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table, as one Spark SQL statement over the parquet files (one
    round trip to build the plan; the same rows as ``WIDE_SQL`` in DuckDB)."""
    return spark.sql(SPARK_WIDE_SQL.format(customer=f"{sf_dir}/customer.parquet", orders=f"{sf_dir}/orders.parquet"))


SPARK_WIDE_SQL = r"""
SELECT c_custkey AS participant_id,
       CAST(NULL AS STRING) AS repeat_kind,
       CAST(NULL AS BIGINT) AS instance,
       date_format(dd, 'yyyy-MM-dd') AS dob,
       date_format(date_add(DATE'2015-01-01', CAST(c_custkey % 2000 AS INT)), 'yyyy-MM-dd') AS enroll_date,
       CAST(NULL AS STRING) AS event_date,
       c_mktsegment AS segment,
       concat('  ', c_mktsegment, char(9)) AS segment_padded,
       CAST(c_nationkey AS BIGINT) AS nation,
       c_acctbal AS acctbal,
       CAST(CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE 1 END AS BIGINT) AS consent,
       c_custkey % 2 AS f1,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 3 END AS BIGINT) AS f2,
       (c_custkey % 5) - 1 AS f3,
       CASE c_custkey % 5
         WHEN 0 THEN concat(CAST(c_custkey % 90 AS STRING), ' years')
         WHEN 1 THEN concat(CAST(c_custkey % 600 AS STRING), ' months')
         WHEN 2 THEN concat(CAST(c_custkey % 300 AS STRING), ' weeks')
         WHEN 3 THEN concat(CAST(c_custkey % 9000 AS STRING), ' days')
         ELSE 'unknown' END AS age_text,
       CASE WHEN c_custkey % 11 = 0 THEN 'n/a'
         ELSE concat(CAST(c_custkey % 50 AS STRING), ',', lpad(CAST((c_custkey * 7) % 1000 AS STRING), 3, '0'), '.5')
       END AS amount_text,
       CASE c_custkey % 6
         WHEN 0 THEN date_format(dd, 'yyyy-MM-dd')
         WHEN 1 THEN date_format(dd, 'yyyy/MM/dd')
         WHEN 2 THEN date_format(dd, 'yyyyMMdd')
         WHEN 3 THEN date_format(dd, 'MM/dd/yyyy')
         WHEN 4 THEN date_format(dd, 'dd/MM/yyyy')
         ELSE date_format(dd, 'yyyy-MM') END AS dob_mixed,
       CASE WHEN c_custkey % 4 = 0
         THEN concat(substr(CAST(year(dd) AS STRING), 1, 1), ',', substr(CAST(year(dd) AS STRING), 2, 3))
         ELSE CAST(year(dd) AS STRING) END AS y_text,
       CASE WHEN c_custkey % 13 = 0 THEN '0' ELSE CAST(month(dd) AS STRING) END AS m_text,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(dayofmonth(dd) AS STRING) END AS d_text,
       CAST(NULL AS STRING) AS order_status,
       CAST(NULL AS STRING) AS priority,
       CAST(NULL AS DOUBLE) AS total_price,
       CAST(datediff(date_add(DATE'2015-01-01', CAST(c_custkey % 2000 AS INT)), DATE'1900-01-01') AS BIGINT)
         * 100000000 + c_custkey AS row_ord
FROM (SELECT *, date_add(DATE'1950-01-01', CAST((c_custkey * 37) % 18000 AS INT)) AS dd
      FROM parquet.`{customer}`) c
UNION ALL
SELECT o_custkey, 'order', o_orderkey, NULL, NULL, date_format(CAST(o_orderdate AS DATE), 'yyyy-MM-dd'),
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       o_orderstatus, o_orderpriority, o_totalprice,
       CAST(1000000000000000 AS BIGINT)
         + CAST(datediff(CAST(o_orderdate AS DATE), DATE'1900-01-01') AS BIGINT) * 100000000 + o_orderkey
FROM parquet.`{orders}`
"""


WIDE_SQL = r"""
wide AS (
  SELECT c_custkey AS participant_id,
         CAST(NULL AS VARCHAR) AS repeat_kind,
         CAST(NULL AS BIGINT) AS instance,
         strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER), '%Y-%m-%d') AS dob,
         strftime(DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d') AS enroll_date,
         CAST(NULL AS VARCHAR) AS event_date,
         c_mktsegment AS segment,
         '  ' || c_mktsegment || chr(9) AS segment_padded,
         CAST(c_nationkey AS BIGINT) AS nation,
         c_acctbal AS acctbal,
         CAST(CASE WHEN c_custkey % 10 = 3 THEN NULL ELSE 1 END AS BIGINT) AS consent,
         c_custkey % 2 AS f1,
         CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 3 END AS BIGINT) AS f2,
         (c_custkey % 5) - 1 AS f3,
         CASE c_custkey % 5
           WHEN 0 THEN CAST(c_custkey % 90 AS VARCHAR) || ' years'
           WHEN 1 THEN CAST(c_custkey % 600 AS VARCHAR) || ' months'
           WHEN 2 THEN CAST(c_custkey % 300 AS VARCHAR) || ' weeks'
           WHEN 3 THEN CAST(c_custkey % 9000 AS VARCHAR) || ' days'
           ELSE 'unknown' END AS age_text,
         CASE WHEN c_custkey % 11 = 0 THEN 'n/a'
           ELSE CAST(c_custkey % 50 AS VARCHAR) || ',' || lpad(CAST((c_custkey * 7) % 1000 AS VARCHAR), 3, '0') || '.5'
         END AS amount_text,
         CASE c_custkey % 6
           WHEN 0 THEN strftime(dd, '%Y-%m-%d')
           WHEN 1 THEN strftime(dd, '%Y/%m/%d')
           WHEN 2 THEN strftime(dd, '%Y%m%d')
           WHEN 3 THEN strftime(dd, '%m/%d/%Y')
           WHEN 4 THEN strftime(dd, '%d/%m/%Y')
           ELSE strftime(dd, '%Y-%m') END AS dob_mixed,
         CASE WHEN c_custkey % 4 = 0 THEN substr(CAST(year(dd) AS VARCHAR), 1, 1) || ',' || substr(CAST(year(dd) AS VARCHAR), 2, 3)
              ELSE CAST(year(dd) AS VARCHAR) END AS y_text,
         CASE WHEN c_custkey % 13 = 0 THEN '0' ELSE CAST(month(dd) AS VARCHAR) END AS m_text,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(day(dd) AS VARCHAR) END AS d_text,
         CAST(NULL AS VARCHAR) AS order_status,
         CAST(NULL AS VARCHAR) AS priority,
         CAST(NULL AS DOUBLE) AS total_price,
         CAST(date_diff('day', DATE '1900-01-01', DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER)) AS BIGINT) * 100000000 + c_custkey AS row_ord
  FROM (SELECT *, DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS dd FROM customer) cc
  UNION ALL
  SELECT o_custkey, 'order', o_orderkey, NULL, NULL, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'),
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         o_orderstatus, o_orderpriority, o_totalprice,
         CAST(1000000000000000 AS BIGINT) + CAST(date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 100000000 + o_orderkey
  FROM orders
)"""
