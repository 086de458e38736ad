"""The audited tables as SQL over the test tables."""

from __future__ import annotations

# Evaluated once per statement; every check below names these.
DOCS = """
docs AS (
  SELECT o_orderkey % 9 AS dom, o_orderkey % 2 AS db, o_orderkey AS id, c_nationkey AS branch_id,
    CASE WHEN o_orderkey % 127 = 0 THEN NULL
         WHEN o_orderkey % 113 = 0 THEN 'BADNO'
         WHEN o_orderkey % 131 = 0 THEN 'A1'
         ELSE 'INV' || (o_orderkey // 5000) || '-' || lpad(CAST((o_orderkey % 5000) // 11 AS VARCHAR), 4, '0')
    END AS entry_number,
    CASE WHEN o_orderkey % 107 = 0 THEN NULL
         WHEN o_orderkey % 103 = 0 THEN ''
         WHEN o_orderkey % 109 = 0 THEN '  '
         ELSE '2024-03-' || lpad(CAST(1 + (o_orderkey // 45) % 10 AS VARCHAR), 2, '0') || ' ' ||
              CASE WHEN o_orderkey % 97 = 0 THEN '00:00:00'
                   ELSE lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':30:00' END
    END AS entry_date,
    CAST(o_orderkey % 10 AS VARCHAR) AS billing_on,
    CAST(o_totalprice AS DECIMAL(18,2)) AS net_amount,
    CAST(o_orderkey % 50 AS DECIMAL(18,2)) AS total_disc,
    CAST(o_orderkey % 30 AS DECIMAL(18,2)) AS total_gst,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + o_orderkey % 50
              - CASE WHEN o_orderkey % 10 IN (3, 8, 9) THEN 0 ELSE o_orderkey % 30 END
              + CASE WHEN o_orderkey % 7 = 0 THEN 1.25 ELSE 0 END AS DECIMAL(18,2))
    END AS gross_total,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS DECIMAL(18,2)) END AS overall_disc,
    o_custkey AS customer_id_id, o_orderkey % 8 AS supplier_id_id,
    o_orderkey % 2 = 0 AS is_retail_b2b_bill, o_orderkey % 2 = 0 AS is_b2b_bill
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
heads AS (
  SELECT *, TRY_CAST(substr(trim(entry_date), 1, 19) AS TIMESTAMP) AS ts,
    TRY_CAST(TRY_CAST(substr(trim(entry_date), 1, 19) AS TIMESTAMP) AS DATE) AS ymd,
    left(entry_number, length(entry_number) - 4) AS pre,
    CASE WHEN regexp_full_match(trim(right(entry_number, 4)), '[+-]?[0-9]+')
         THEN CAST(trim(right(entry_number, 4)) AS INTEGER) END AS num,
    length(entry_number) >= 4 AND regexp_full_match(right(entry_number, 4), '[0-9]{4}') AS ok
  FROM docs)"""

ITEMS = """
items AS (
  SELECT l_orderkey % 2 AS db, l_orderkey AS hid, CAST(l_extendedprice AS DECIMAL(18,2)) AS val,
    CAST(round(l_discount * 100) AS DECIMAL(18,2)) AS disc,
    CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS gst,
    CAST(CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * round(l_tax * 100) / 100
      AS DECIMAL(28,6)) AS DECIMAL(18,2)) AS gst_value,
    CAST(l_quantity AS INTEGER) * CASE WHEN l_partkey % 3 = 0 THEN 150 ELSE 1 END AS qty,
    l_linenumber AS free
  FROM lineitem)"""

DIMENSIONS = """
branches AS (
  SELECT n_nationkey AS bid, n_name AS bname, lower(n_name) || '.example' AS bdomain, n_regionkey AS client
  FROM nation),
clients AS (SELECT r_regionkey AS cid, r_name AS cname FROM region),
buyers AS (
  SELECT c_custkey AS uid, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS factor
  FROM customer),
settings AS (
  SELECT n_nationkey AS sbranch, n_nationkey % 3 = 0 AS overrides FROM nation WHERE n_nationkey % 5 <> 4
  UNION ALL
  SELECT n_nationkey, n_nationkey % 3 = 0 FROM nation WHERE n_nationkey = 7)"""

TABLES = ",".join((DOCS, ITEMS, DIMENSIONS))
