"""The same queries as SQL over views named like the test tables."""

from __future__ import annotations

_AS_OF = "DATE '2000-01-01'"
_CLEANSE_AS_OF = "DATE '2025-01-01'"
_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _int_date(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return (
        f"CASE WHEN length({text}) = 8 THEN TRY_CAST(substr({text}, 1, 4) || '-' || "
        f"substr({text}, 5, 2) || '-' || substr({text}, 7, 2) AS DATE) END"
    )


def _yyyymmdd(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


# Common table expressions by name; each may use the ones before it.
_CTES = {
    "cust_info": """
        SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'P'
                    THEN o_custkey END AS cst_id,
               'AW' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS cst_key,
               '  ' || o_orderpriority || ' ' AS cst_firstname,
               ' Order ' || o_orderkey AS cst_lastname,
               CASE o_orderstatus WHEN 'F' THEN ' s' WHEN 'O' THEN 'M ' END AS cst_marital_status,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'f ' WHEN '2' THEN ' M'
                    WHEN '3' THEN 'x' WHEN '4' THEN '' END AS cst_gndr,
               CASE WHEN o_totalprice >= 20000 THEN CAST(o_orderdate AS DATE) END AS cst_create_date
        FROM orders""",
    "customers": """
        SELECT CASE WHEN c_acctbal < 0 THEN 'ZZ'
                    WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'NASAW' ELSE 'AW' END
                   || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS cid,
               CASE WHEN c_acctbal > 9000 THEN '9999-11-20' WHEN c_acctbal > 8000 THEN NULL
                    WHEN c_acctbal > 7000 THEN 'unknown'
                    ELSE CAST(DATE '1950-01-01' + c_nationkey * 300 AS VARCHAR) END AS bdate,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'F' WHEN 'BUILDING' THEN 'Female'
                    WHEN 'FURNITURE' THEN ' m ' WHEN 'HOUSEHOLD' THEN '' END AS gen
        FROM customer""",
    "customer_locations": """
        SELECT 'A-W-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS cid,
               CASE c_nationkey WHEN 0 THEN ' DE ' WHEN 1 THEN 'USA' WHEN 2 THEN 'US'
                    WHEN 3 THEN '' WHEN 4 THEN '  ' WHEN 5 THEN 'us' WHEN 6 THEN NULL
                    ELSE ' Nation ' || c_nationkey || ' ' END AS cntry
        FROM customer""",
    "prd_info": """
        SELECT p_partkey AS prd_id,
               substr(p_type, 1, 2) || '-' || upper(substr(p_name, 1, 2)) || '-P'
                   || lpad(CAST(p_partkey // 3 AS VARCHAR), 12, '0') AS prd_key,
               p_name AS prd_nm,
               CASE WHEN p_size <> 7 THEN CAST(floor(p_retailprice) AS DOUBLE) END AS prd_cost,
               CASE p_type WHEN 'ECONOMY' THEN 'R ' WHEN 'LARGE' THEN 'M ' WHEN 'MEDIUM' THEN 's'
                    WHEN 'PROMO' THEN ' t' WHEN 'STANDARD' THEN 'x' END AS prd_line,
               DATE '2003-07-01' + p_size AS prd_start_dt
        FROM part""",
    "product_categories": """
        SELECT replace(substr(p_type, 1, 2), 'PR', 'PX') || '_' || upper(substr(p_name, 1, 2)) AS id,
               min(p_type) AS cat,
               min(split_part(p_name, ' ', 1)) AS subcat,
               CASE WHEN max(p_size) > 25 THEN 'Yes' ELSE 'No' END AS maintenance
        FROM part GROUP BY 1""",
    "sales_details": f"""
        SELECT 'SO' || l_orderkey AS sls_ord_num,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'UNKNOWN'
                    ELSE 'P' || lpad(CAST(l_partkey // 3 AS VARCHAR), 12, '0') END AS sls_prd_key,
               CASE WHEN l_returnflag <> 'R' OR l_linenumber <> 6 THEN o_custkey END AS sls_cust_id,
               CASE q WHEN 1 THEN 0 WHEN 2 THEN 5489 WHEN 3 THEN 20101345 WHEN 4 THEN NULL
                    ELSE {_yyyymmdd('o_orderdate')} END AS sls_order_dt,
               {_yyyymmdd('l_shipdate')} AS sls_ship_dt,
               {_yyyymmdd("l_shipdate + INTERVAL 7 DAY")} AS sls_due_dt,
               CAST(CASE l_returnflag || l_linestatus WHEN 'AF' THEN NULL WHEN 'RF' THEN -q * unit
                    WHEN 'NO' THEN 999 ELSE q * unit END AS DOUBLE) AS sls_sales,
               CASE WHEN l_linenumber = 5 AND l_linestatus = 'O' THEN 0 ELSE q END AS sls_quantity,
               CAST(CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0
                    WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN -unit
                    ELSE unit END AS DOUBLE) AS sls_price
        FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q,
                     CAST(floor(l_extendedprice / 100) AS DOUBLE)
                         + CAST(CASE WHEN l_linenumber = 4 THEN 0.5 ELSE 0 END AS DOUBLE) AS unit
              FROM lineitem) AS l
        LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "cl_cust_info": """
        SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname,
               trim(cst_lastname) AS cst_lastname,
               CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married'
                    ELSE 'n/a' END AS cst_marital_status,
               CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male'
                    ELSE 'n/a' END AS cst_gndr,
               cst_create_date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY cst_id
                  ORDER BY cst_create_date DESC NULLS LAST, cst_key NULLS FIRST,
                           cst_firstname NULLS FIRST, cst_lastname NULLS FIRST,
                           cst_marital_status NULLS FIRST, cst_gndr NULLS FIRST) AS place
              FROM cust_info WHERE cst_id IS NOT NULL) AS ranked
        WHERE place = 1""",
    "cl_customers": f"""
        SELECT regexp_replace(cid, '^NAS', '') AS cid,
               CASE WHEN TRY_CAST(bdate AS DATE) > {_CLEANSE_AS_OF} THEN NULL ELSE bdate END AS bdate,
               CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
                    WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gen
        FROM customers""",
    "cl_customer_locations": """
        SELECT regexp_replace(cid, '-', '', 'g') AS cid,
               CASE WHEN trim(cntry) = 'DE' THEN 'Germany'
                    WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
                    WHEN trim(cntry) = '' OR cntry IS NULL THEN 'n/a'
                    ELSE trim(cntry) END AS cntry
        FROM customer_locations""",
    "cl_prd_info": """
        SELECT prd_id, replace(substr(prd_key, 1, 5), '-', '_') AS cat_id,
               substr(prd_key, 7) AS prd_key, prd_nm, coalesce(prd_cost, 0) AS prd_cost,
               CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road'
                    WHEN 'S' THEN 'Other Sales' WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS prd_line,
               prd_start_dt,
               lead(prd_start_dt) OVER (PARTITION BY substr(prd_key, 7)
                                        ORDER BY prd_start_dt, prd_id) - 1 AS prd_end_dt
        FROM prd_info""",
    "priced": """
        SELECT *, CASE WHEN sls_sales IS NULL OR sls_sales <= 0
                         OR sls_sales <> sls_quantity * abs(sls_price)
                       THEN sls_quantity * abs(sls_price) ELSE sls_sales END AS repaired
        FROM sales_details""",
    "cl_sales_details": f"""
        SELECT sls_ord_num, sls_prd_key, sls_cust_id,
               {_int_date('sls_order_dt')} AS sls_order_dt,
               {_int_date('sls_ship_dt')} AS sls_ship_dt,
               {_int_date('sls_due_dt')} AS sls_due_dt,
               repaired AS sls_sales, sls_quantity,
               round(CASE WHEN sls_price IS NULL OR sls_price <= 0
                          THEN CASE WHEN sls_quantity <> 0
                                    THEN CAST(repaired AS DOUBLE) / sls_quantity END
                          ELSE CAST(sls_price AS DOUBLE) END, 4) AS sls_price
        FROM priced""",
    "dim_customer": """
        SELECT row_number() OVER (ORDER BY cst_id, cst_key) AS customer_key,
               cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
               cst_lastname AS last_name, cntry AS country, cst_marital_status AS marital_status,
               CASE WHEN cst_gndr <> 'n/a' THEN cst_gndr ELSE coalesce(gen, 'n/a') END AS gender,
               bdate AS birthdate, cst_create_date AS create_date
        FROM cl_cust_info AS c
        LEFT JOIN cl_customers AS e ON c.cst_key = e.cid
        LEFT JOIN cl_customer_locations AS l ON e.cid = l.cid""",
    "dim_product": """
        SELECT row_number() OVER (ORDER BY prd_start_dt, prd_key) AS product_key,
               prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name,
               cat_id AS category_id, cat AS category, subcat AS subcategory, maintenance,
               prd_cost AS cost, prd_line AS product_line, prd_start_dt AS start_date
        FROM cl_prd_info LEFT JOIN product_categories ON cat_id = id
        WHERE prd_end_dt IS NULL""",
    "fact_sales": """
        SELECT sls_ord_num AS order_number, product_key, customer_key,
               CAST(sls_order_dt AS VARCHAR) AS order_date,
               CAST(sls_ship_dt AS VARCHAR) AS shipping_date,
               CAST(sls_due_dt AS VARCHAR) AS due_date,
               sls_sales AS sales_amount, sls_quantity AS quantity, sls_price AS price
        FROM cl_sales_details
        LEFT JOIN dim_product ON sls_prd_key = product_number
        LEFT JOIN dim_customer ON sls_cust_id = customer_id""",
}

_FACT = "SELECT * FROM fact_sales"


def _with(sql: str) -> str:
    ctes = ", ".join(f"{name} AS ({body})" for name, body in _CTES.items())
    return f"WITH {ctes} {sql}"


def _compared(name: str, other: str) -> str:
    """Both tables' rows, and whether they are the same, each as often."""
    return f"""
        SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS rows,
               (SELECT count(*) FROM ({other}) AS c) AS other_rows,
               NOT EXISTS (SELECT * FROM {name} EXCEPT ALL SELECT * FROM ({other}) AS c)
               AND NOT EXISTS (SELECT * FROM ({other}) AS c EXCEPT ALL SELECT * FROM {name}) AS same"""


def _count_all(tables: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count{extra} FROM {t}" for t in tables
    )


_VALIDITY = """
    SELECT {key}, o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
           lead(CAST(o_orderdate AS DATE)) OVER (
               PARTITION BY {key} ORDER BY o_orderdate, o_orderkey) - 1 AS end_date
    FROM orders"""
_VALIDITY_TEXT = """
    SELECT {key}, o_orderkey, CAST(start_date AS VARCHAR) AS o_orderdate,
           CAST(end_date AS VARCHAR) AS end_date FROM (""" + _VALIDITY + ") AS v"
_SPOILED_DAY = f"""
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN 5489
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 20101345
                WHEN o_orderpriority = '5-LOW' THEN NULL
                ELSE {_yyyymmdd('o_orderdate')} END AS day
    FROM orders"""
_ORDERS_TEXT = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
           AS o_orderdate, o_orderpriority, round(o_totalprice, 2) AS o_totalprice FROM orders"""

# What is spoilt in the text versions of the sources, and counted as rejected.
_REJECTS = [
    ("cust_info", "cst_id", "cst_id % 10 = 3"),
    ("prd_info", "prd_cost", "prd_id % 7 = 0"),
    ("sales_details", "sls_cust_id", "sls_quantity = 7"),
    ("sales_details", "sls_price", "sls_quantity = 4"),
]
_ERP_PROMISES = [
    ("product_categories", ["id"], ["cat", "subcat"], [("id", 10), ("cat", 50), ("subcat", 50), ("maintenance", 5)]),
    ("customer_locations", ["cid"], ["cntry"], [("cid", 20), ("cntry", 50)]),
    ("customers", ["cid"], [], [("cid", 20), ("bdate", 50), ("gen", 10)]),
]
_STAR_COLUMNS = {
    "dim_customer": "customer_key customer_id customer_number first_name last_name country "
    "marital_status gender birthdate create_date",
    "dim_product": "product_key product_id product_number product_name category_id category "
    "subcategory maintenance cost product_line start_date",
    "fact_sales": "order_number product_key customer_key order_date shipping_date due_date "
    "sales_amount quantity price",
}


def _check(layer: str, table: str, check: str, column: str, count: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{check}' AS check_name, "
        f"'{column}' AS column_name, CAST(({count}) AS BIGINT) AS violations"
    )


def _run_checks() -> str:
    found = []
    for table, key, filled, lengths in _ERP_PROMISES:
        columns = ", ".join(key)
        twice = f"SELECT 1 FROM {table} WHERE {key[0]} IS NOT NULL GROUP BY {columns} HAVING count(*) > 1"
        found.append(_check("raw", table, "unique", ",".join(key), f"SELECT count(*) FROM ({twice}) d"))
        for c in [*key, *filled]:
            found.append(_check("raw", table, "not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL"))
        for c, n in lengths:
            found.append(_check("raw", table, "length", c, f"SELECT count(*) FROM {table} WHERE length({c}) > {n}"))
    for table, key in (("dim_customer", "customer_key"), ("dim_product", "product_key")):
        twice = f"SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1"
        found.append(_check("star", table, "unique", key, f"SELECT count(*) FROM ({twice}) d"))
        found.append(_check("star", table, "not_null", key, f"SELECT count(*) FROM {table} WHERE {key} IS NULL"))
    for table, columns in _STAR_COLUMNS.items():
        found += [_check("star", table, "schema", c, "SELECT 0") for c in columns.split()]
    return _with(" UNION ALL ".join(found))


def oracle_sql() -> dict[str, str]:
    return {
        "validate_row_counts": _count_all(_TABLES),
        "compare_contents": " UNION ALL ".join(
            (
                _compared("orders", "SELECT * FROM orders"),
                _compared(
                    "customer",
                    """SELECT * REPLACE (CASE WHEN c_custkey = 7 THEN 'OTHER' ELSE c_mktsegment END
                       AS c_mktsegment) FROM customer""",
                ),
                _compared(
                    "part",
                    """SELECT * FROM part WHERE p_partkey <> 2
                       UNION ALL SELECT * FROM part WHERE p_partkey = 1""",
                ),
                _compared(
                    "lineitem", "SELECT * FROM lineitem WHERE NOT (l_orderkey = 1 AND l_linenumber = 1)"
                ),
            )
        ),
        "compare_row_counts": """
            SELECT 'nation' AS table_name, (SELECT count(*) FROM nation) AS row_count,
                   25 AS expected, (SELECT count(*) FROM nation) = 25 AS matches
            UNION ALL
            SELECT 'orders', o.n, c.n, o.n = c.n
            FROM (SELECT count(*) AS n FROM orders) AS o, (SELECT count(*) AS n FROM customer) AS c
            UNION ALL
            SELECT 'customer', NULL, count(*), FALSE FROM customer""",
        "constraint_checks": """
            SELECT 'unique' AS check_name, 'l_orderkey,l_linenumber' AS column_name,
                   count(*) AS violations
            FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS d
            UNION ALL
            SELECT 'not_null', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey IS NULL
            UNION ALL
            SELECT 'not_null', 'l_linenumber', count(*) FROM lineitem WHERE l_linenumber IS NULL
            UNION ALL
            SELECT 'not_null', 'l_suppkey', count(*) FROM lineitem WHERE nullif(l_suppkey, 3) IS NULL
            UNION ALL
            SELECT 'length', 'l_returnflag', count(*) FROM lineitem WHERE length(l_returnflag) > 1
            UNION ALL
            SELECT 'length', 'l_linestatus', count(*) FROM lineitem WHERE length(l_linestatus) > 0
            UNION ALL SELECT 'schema', 'l_orderkey', 0
            UNION ALL SELECT 'schema', 'l_quantity', 1
            UNION ALL SELECT 'schema', 'l_absent', 1""",
        "readiness_check": " UNION ALL ".join(
            f"SELECT '{t}' AS name, count(*) > 0 AS present, count(*) AS rows FROM {t}"
            for t in _TABLES
        )
        + " UNION ALL SELECT 'absent', FALSE, NULL",
        "latest_per_key": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                   CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) AS r
            WHERE place = 1""",
        "scd2_validity": _VALIDITY_TEXT.format(key="o_custkey"),
        "scd2_validity_hot_key": _VALIDITY_TEXT.format(key="o_orderstatus"),
        "current_version": _VALIDITY_TEXT.format(key="o_custkey") + " WHERE end_date IS NULL",
        "dense_key_scalable": """
            SELECT row_number() OVER (ORDER BY day DESC NULLS LAST, o_orderkey) AS order_number,
                   CAST(day AS VARCHAR) AS o_orderdate, o_orderkey, o_totalprice
            FROM (SELECT *, CASE WHEN o_totalprice >= 20000 THEN CAST(o_orderdate AS DATE) END AS day
                  FROM orders) AS o""",
        "left_join_chain": """
            SELECT c_custkey, n_name AS nation, r_name AS region
            FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS c_nationkey
                  FROM customer) AS c
            LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN (SELECT CASE WHEN r_name = 'ASIA' THEN 99 ELSE r_regionkey END AS r_regionkey,
                              r_name FROM region) AS r ON n_regionkey = r_regionkey""",
        "lookup_fan_out": """
            SELECT o_orderkey, o_custkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
        "lookup_hot_key": """
            SELECT o_orderkey, o.o_custkey, o_orderstatus, c_name
            FROM (SELECT o_orderkey, o_orderstatus,
                         CASE o_orderstatus WHEN 'P' THEN 7 WHEN 'O' THEN NULL
                              ELSE o_custkey END AS o_custkey FROM orders) AS o
            LEFT JOIN customer ON o.o_custkey = c_custkey""",
        "recode_codes": """
            SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open'
                               ELSE 'n/a' END AS status FROM orders""",
        "recode_in_list": """
            SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Home'
                                   WHEN c_mktsegment IN ('MACHINERY', 'building') THEN 'Works'
                                   ELSE c_mktsegment END AS segment FROM customer""",
        "recode_shadowed": """
            SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL
                                    THEN upper(trim(' ' || lower(o_orderstatus)))
                                    WHEN upper(o_orderstatus) IN ('F') THEN 'Filled'
                                    ELSE 'n/a' END AS status FROM orders""",
        "key_split": """
            SELECT c_custkey, replace(substr(c_name, 1, 9), '#', '_') AS name_part,
                   substr(c_name, 11) AS number_part FROM customer""",
        "regex_strip": """
            SELECT o_orderkey, regexp_replace(o_orderpriority, '-', '', 'g') AS without_dash,
                   regexp_replace(o_orderpriority, '^1-', '') AS without_prefix FROM orders""",
        "int_date_parse": f"""
            SELECT o_orderkey, CAST({_int_date('day')} AS VARCHAR) AS day
            FROM ({_SPOILED_DAY}) AS s""",
        "rejected_dates": f"""
            SELECT 'day' AS column_name, count(*) AS rejects FROM ({_SPOILED_DAY}) AS s
            WHERE length(CAST(day AS VARCHAR)) = 8 AND {_int_date('day')} IS NULL""",
        "sales_repair": _with(
            "SELECT sls_ord_num, sls_prd_key, sls_sales, sls_quantity, sls_price "
            "FROM cl_sales_details"
        ),
        "future_date_null": f"""
            SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) > {_AS_OF} THEN NULL
                               ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_day
            FROM orders""",
        "null_default": """
            SELECT p_partkey, CAST(coalesce(nullif(p_size, 1), 0) AS BIGINT) AS size FROM part""",
        "coalesce_fallback": """
            SELECT c_custkey,
                   CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Auto' WHEN 'BUILDING' THEN 'Build'
                        ELSE coalesce(n_name, 'n/a') END AS kind
            FROM customer LEFT JOIN nation
                 ON CASE WHEN c_acctbal >= 0 THEN c_nationkey END = n_nationkey""",
        "preview": """
            SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_custkey
            FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 3""",
        "literal_rows": """
            SELECT o_orderkey, o_orderstatus, label FROM orders
            LEFT JOIN (VALUES ('F', 'Filled'), ('O', 'Open')) AS l(code, label)
                 ON o_orderstatus = code""",
        "clean_crm_customer": _with(
            "SELECT * REPLACE (CAST(cst_create_date AS VARCHAR) AS cst_create_date) "
            "FROM cl_cust_info"
        ),
        "clean_crm_product": _with(
            "SELECT * REPLACE (CAST(prd_start_dt AS VARCHAR) AS prd_start_dt, "
            "CAST(prd_end_dt AS VARCHAR) AS prd_end_dt) FROM cl_prd_info"
        ),
        "clean_crm_sales": _with(
            "SELECT * REPLACE (CAST(sls_order_dt AS VARCHAR) AS sls_order_dt, "
            "CAST(sls_ship_dt AS VARCHAR) AS sls_ship_dt, "
            "CAST(sls_due_dt AS VARCHAR) AS sls_due_dt) FROM cl_sales_details"
        ),
        "clean_erp_customer": _with("SELECT * FROM cl_customers"),
        "clean_erp_customer_as_observed": _with(
            "SELECT c.cid, c.bdate, CASE WHEN s.gen IS NOT NULL THEN upper(trim(s.gen)) "
            "ELSE 'n/a' END AS gen FROM customers AS s "
            "JOIN cl_customers AS c ON regexp_replace(s.cid, '^NAS', '') = c.cid"
        ),
        "clean_erp_location": _with("SELECT * FROM cl_customer_locations"),
        "clean_erp_category": _with("SELECT * FROM product_categories"),
        "dim_customer": _with(
            "SELECT * REPLACE (CAST(create_date AS VARCHAR) AS create_date) FROM dim_customer"
        ),
        "dim_product": _with(
            "SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date) FROM dim_product"
        ),
        "fact_sales": _with(_FACT),
        "star_schema_counts": _with(_count_all(["dim_customer", "dim_product", "fact_sales"])),
        "csv_roundtrip": _ORDERS_TEXT,
        "csv_inferred": _ORDERS_TEXT,
        "csv_all_string": """
            SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
                   CAST(p_size AS VARCHAR) AS p_size,
                   CAST(CAST(p_retailprice AS DECIMAL(18, 4)) AS VARCHAR) AS p_retailprice
            FROM part""",
        "csv_declared_schema": """
            SELECT p_partkey AS part_id, p_brand || ' ' || p_type AS label, p_name AS name,
                   round(p_retailprice, 2) AS price
            FROM part""",
        "csv_land_raw": _count_all(
            _TABLES, ", 'loaded' AS status, CAST(0 AS BIGINT) AS malformed"
        ),
        "csv_land_texts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key, md5({text}) AS text_md5 FROM {name}"
            for name, key, text in (
                ("documents", "doc_id", "text"),
                ("pages", "page_id", "html"),
                ("benchmark", "item_id", "text"),
                ("conversations", "conv_id || ':' || turn", "text"),
            )
        ),
        "ingest_all": _count_all(_TABLES, ", 'loaded' AS status"),
        "ingest_summary": f"""
            SELECT count(*) AS succeeded, count(*) AS total,
                   CAST(sum(row_count) AS BIGINT) AS row_count
            FROM ({_count_all(_TABLES)}) AS counted""",
        "reject_counts": _with(
            " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rejects "
                f"FROM {t} WHERE {rule} AND {c} IS NOT NULL HAVING count(*) > 0"
                for t, c, rule in _REJECTS
            )
        ),
        "run_checks": _run_checks(),
        "whole_run_contents": _with(
            """SELECT order_number, product_number, product_name, category, cost, customer_number,
                      country, gender, birthdate, order_date, sales_amount, quantity, price
               FROM fact_sales AS f
               LEFT JOIN dim_product AS p ON f.product_key = p.product_key
               LEFT JOIN dim_customer AS c ON f.customer_key = c.customer_key"""
        ),
        "warehouse_load": _with(_FACT),
        "whole_run": _with(
            _count_all(
                ["dim_customer", "dim_product", "fact_sales"],
                ", count(*) AS expected, TRUE AS matches",
            )
        ),
    }
