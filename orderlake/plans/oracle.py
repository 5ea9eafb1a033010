"""Oracle SQL (DuckDB dialect) for the registered queries.

Each query is the shared chain of CTEs below plus a final SELECT. The
chain restates every layer in plain SQL over the same order tables:
raw rows, bronze, the deduplicated rows, cleaned rows, silver, completed
orders and the three marts. Money leaves as DOUBLE on both sides; null
order is spelled out because DuckDB sorts nulls last by default.
"""

from __future__ import annotations

from orderlake import schema
from orderlake.sources import tables


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def avg2(x: str) -> str:
    """Exact half-up mean to two places, as DOUBLE."""
    cents = f"CAST(SUM({x}) * 100 AS HUGEINT)"
    return (
        f"CASE WHEN COUNT({x}) = 0 THEN NULL ELSE CAST(sign({cents}) * "
        f"((2 * abs({cents}) + COUNT({x})) // (2 * COUNT({x}))) AS DOUBLE) / 100 END"
    )


def _dedup_order() -> str:
    keys = ["_ingested_at DESC NULLS LAST", "created_at DESC NULLS LAST"]
    keys += [f"{c} ASC NULLS FIRST" for c in schema.DEDUP_TIEBREAK]
    return ", ".join(keys)


def _bucket(x: str) -> str:
    whens = " ".join(f"WHEN {x} < {b} THEN '{label}'" for b, label in schema.REVENUE_BUCKETS)
    return f"CASE {whens} ELSE '{schema.TOP_BUCKET}' END"


def _segment(x: str) -> str:
    whens = " ".join(f"WHEN {x} >= {m} THEN '{label}'" for m, label in schema.SEGMENTS)
    return f"CASE {whens} ELSE '{schema.LAST_SEGMENT}' END"


TS = "'%Y-%m-%d %H:%M:%S'"
CUSTOMER_TIES = "customer_id ASC NULLS FIRST, customer_name ASC NULLS FIRST, region ASC NULLS FIRST"

RAW_SQL = f"""
raw AS (
  SELECT
    CASE WHEN l.l_orderkey % {tables.NULL_ID_EVERY} <> 0
         THEN printf('ORD-%08d-%d', l.l_orderkey, l.l_linenumber) END AS order_id,
    printf('CUST-%06d', o.o_custkey) AS customer_id,
    c.c_name AS customer_name,
    ' ' || upper(replace(c.c_name, '#', '.')) || '@EXAMPLE.com ' AS customer_email,
    r.r_name AS region,
    n.n_name AS city,
    n.n_name AS state,
    printf('PROD-%06d', l.l_partkey) AS product_id,
    p.p_name AS product_name,
    upper(p.p_type) AS category,
    CAST(trunc(l.l_quantity) AS INTEGER)
      + CASE WHEN l.l_orderkey % {tables.BAD_QUANTITY_EVERY} = 0 THEN 100 ELSE 0 END AS quantity,
    CASE WHEN l.l_orderkey % {tables.NEGATIVE_PRICE_EVERY} = 0
         THEN -p.p_retailprice ELSE p.p_retailprice END AS unit_price,
    round(l.l_discount * 100, 0) AS discount_pct,
    CAST(0 AS DOUBLE) AS discount_amount,
    CAST(0 AS DOUBLE) AS gross_revenue,
    CAST(0 AS DOUBLE) AS net_revenue,
    o.o_orderpriority AS payment_method,
    CASE WHEN l.l_orderkey % {tables.BAD_STATUS_EVERY} = 0 THEN 'UNKNOWN'
         WHEN l.l_returnflag = 'R' THEN 'Refunded'
         WHEN o.o_orderstatus = 'F' THEN ' COMPLETED '
         WHEN o.o_orderstatus = 'O' THEN 'Pending'
         ELSE 'completed' END AS status,
    strftime(o.o_orderdate, {TS}) AS order_date,
    CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
    CAST(month(o.o_orderdate) AS INTEGER) AS order_month,
    CAST(day(o.o_orderdate) AS INTEGER) AS order_day,
    strftime(l.l_shipdate, {TS}) AS created_at
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

VALID_COND = " AND ".join(f"{c} IS NOT NULL" for c in schema.REQUIRED_COLUMNS)

CHAIN = [
    RAW_SQL,
    f"""
valid AS (SELECT * FROM raw WHERE {VALID_COND})""",
    f"""
bronze AS (
  SELECT *,
    try_strptime(created_at, {TS}) AS _ingested_at,
    '{tables.SOURCE_LABEL}' AS _source_path,
    strftime(try_strptime(created_at, {TS}), '%Y-%m-%dT%H%M%S') AS _pipeline_run_id
  FROM valid)""",
    f"""
arrivals AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY order_id ORDER BY {_dedup_order()}) AS INTEGER)
    AS arrival_rank
  FROM bronze)""",
    """
dedup AS (SELECT * EXCLUDE (arrival_rank) FROM arrivals WHERE arrival_rank = 1)""",
    f"""
clean_text AS (
  SELECT * REPLACE (
    trim(lower(status)) AS status,
    trim({_initcap('category')}) AS category,
    trim(region) AS region,
    trim(lower(payment_method)) AS payment_method,
    trim(lower(customer_email)) AS customer_email)
  FROM dedup)""",
    f"""
clean_rules AS (
  SELECT * REPLACE (
    CASE WHEN status IN ({_in_list(schema.VALID_STATUSES)}) THEN status END AS status,
    CASE WHEN unit_price > 0 THEN TRY_CAST(unit_price AS {schema.UNIT_PRICE_TYPE}) END AS unit_price,
    TRY_CAST(discount_pct AS {schema.DISCOUNT_PCT_TYPE}) AS discount_pct,
    CASE WHEN quantity BETWEEN {schema.QUANTITY_RANGE[0]} AND {schema.QUANTITY_RANGE[1]}
         THEN quantity END AS quantity,
    try_strptime(order_date, {TS}) AS order_date)
  FROM clean_text)""",
    f"""
clean_gross AS (
  SELECT * REPLACE (CAST(quantity * unit_price AS {schema.AMOUNT_TYPE}) AS gross_revenue)
  FROM clean_rules)""",
    f"""
clean_discount AS (
  SELECT * REPLACE (
    TRY_CAST(round(gross_revenue * discount_pct * CAST(0.01 AS DECIMAL(3,2)), 2)
             AS {schema.AMOUNT_TYPE}) AS discount_amount)
  FROM clean_gross)""",
    f"""
clean AS (
  SELECT * REPLACE (TRY_CAST(gross_revenue - discount_amount AS {schema.AMOUNT_TYPE}) AS net_revenue)
  FROM clean_discount)""",
    f"""
silver AS (
  SELECT *,
    {_bucket('net_revenue')} AS revenue_bucket,
    discount_pct > 0 AS is_discounted,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    CAST(weekofyear(order_date) AS INTEGER) AS order_week
  FROM clean)""",
    f"""
completed AS (SELECT * FROM silver WHERE status = '{schema.COMPLETED}')""",
    f"""
sales_by_region AS (
  SELECT *, CAST(rank() OVER (PARTITION BY order_year, order_month
                              ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank
  FROM (
    SELECT region, order_year, order_month,
      COUNT(order_id) AS total_orders,
      CAST(SUM(net_revenue) AS DOUBLE) AS total_revenue,
      {avg2('net_revenue')} AS avg_order_value,
      CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
      COUNT(DISTINCT customer_id) AS unique_customers,
      CAST(SUM(CASE WHEN is_discounted THEN net_revenue ELSE 0 END) AS DOUBLE) AS discounted_revenue
    FROM completed GROUP BY region, order_year, order_month))""",
    f"""
product_performance AS (
  SELECT *, CAST(rank() OVER (PARTITION BY category
                              ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS rank_in_category
  FROM (
    SELECT product_id, product_name, category,
      CAST(SUM(net_revenue) AS DOUBLE) AS total_revenue,
      CAST(SUM(quantity) AS BIGINT) AS total_units,
      COUNT(order_id) AS total_orders,
      {avg2('unit_price')} AS avg_price,
      {avg2('discount_pct')} AS avg_discount_pct,
      COUNT(DISTINCT customer_id) AS unique_buyers
    FROM completed GROUP BY product_id, product_name, category))""",
    """
rfm_base AS (
  SELECT customer_id, customer_name, region,
    MAX(order_date) AS last_order_date,
    COUNT(order_id) AS frequency,
    SUM(net_revenue) AS monetary
  FROM completed GROUP BY customer_id, customer_name, region)""",
    """
rfm_recency AS (
  SELECT *, CAST(CAST((SELECT MAX(order_date) FROM completed) AS DATE)
                 - CAST(last_order_date AS DATE) AS INTEGER) AS recency_days
  FROM rfm_base)""",
    f"""
rfm_tiles AS (
  SELECT *,
    CAST(ntile({schema.RFM_TILES}) OVER (ORDER BY recency_days ASC NULLS FIRST, {CUSTOMER_TIES}) AS INTEGER) AS r_tile,
    CAST(ntile({schema.RFM_TILES}) OVER (ORDER BY frequency DESC NULLS LAST, {CUSTOMER_TIES}) AS INTEGER) AS f_tile,
    CAST(ntile({schema.RFM_TILES}) OVER (ORDER BY monetary DESC NULLS LAST, {CUSTOMER_TIES}) AS INTEGER) AS m_tile
  FROM rfm_recency)""",
    f"""
customer_segments AS (
  SELECT customer_id, customer_name, region, last_order_date, frequency,
    CAST(round(monetary, 2) AS DOUBLE) AS monetary, recency_days,
    r_tile AS r_score, f_tile AS f_score, m_tile AS m_score,
    r_tile + f_tile + m_tile AS rfm_score,
    {_segment('r_tile + f_tile + m_tile')} AS segment
  FROM rfm_tiles)""",
    f"""
customer_segments_standard AS (
  SELECT customer_id, customer_name, region, last_order_date, frequency,
    CAST(round(monetary, 2) AS DOUBLE) AS monetary, recency_days,
    {schema.RFM_TILES + 1} - r_tile AS r_score,
    {schema.RFM_TILES + 1} - f_tile AS f_score,
    {schema.RFM_TILES + 1} - m_tile AS m_score,
    {3 * (schema.RFM_TILES + 1)} - r_tile - f_tile - m_tile AS rfm_score,
    {_segment(f'{3 * (schema.RFM_TILES + 1)} - r_tile - f_tile - m_tile')} AS segment
  FROM rfm_tiles)""",
]

PREFIX = "WITH" + ",".join(CHAIN) + "\n"

MONEY_OUT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schema.MONEY_COLUMNS)


def q(select: str) -> str:
    """A full statement: the shared chain plus ``select``."""
    return PREFIX + select


def _money(table: str) -> str:
    return f"SELECT * REPLACE ({MONEY_OUT}) FROM {table}"


def _csv_field(c: str, dtype: str) -> str:
    if dtype == "string":
        text = f"""'"' || replace({c}, '"', '""') || '"'"""
    elif dtype == "double":
        text = f"printf('%.2f', {c})"
    else:
        text = f"CAST({c} AS VARCHAR)"
    return f"coalesce({text}, '')"


def _corrupt_sql() -> str:
    types = {f.name: f.dataType.simpleString() for f in schema.RAW_SCHEMA.fields}
    cols = schema.RAW_COLUMNS
    kind = "CASE WHEN order_day % 10 = quantity % 10 THEN order_day % 10 ELSE 0 END"
    fields = {c: _csv_field(c, types[c]) for c in cols}
    fields["quantity"] = (
        f"""CASE WHEN kind = 1 THEN '"qty' || CAST(quantity AS VARCHAR) || '"' """
        f"ELSE {fields['quantity']} END"
    )
    fields["customer_id"] = f"CASE WHEN kind = 4 THEN '' ELSE {fields['customer_id']} END"
    full = "concat_ws(',', " + ", ".join(fields[c] for c in cols) + ")"
    short = "concat_ws(',', " + ", ".join(fields[c] for c in cols[:-2]) + ")"
    parsed = []
    for c in cols:
        if c == "quantity":
            parsed.append("CASE WHEN kind = 1 THEN NULL ELSE quantity END AS quantity")
        elif c in ("order_day", "created_at"):
            parsed.append(f"CASE WHEN kind = 2 THEN NULL ELSE {c} END AS {c}")
        else:
            parsed.append(c)
    line = (
        f"CASE WHEN kind = 2 THEN {short} WHEN kind = 3 THEN {full} || ',\"extra\"' "
        f"ELSE {full} END"
    )
    return q(
        f"SELECT {', '.join(parsed)}, {line} AS {schema.CORRUPT_COLUMN} "
        f"FROM (SELECT *, {kind} AS kind FROM raw) WHERE kind IN (1, 2, 3)"
    )


def _synthetic_sql() -> str:
    from orderlake.sources import synthetic as syn

    def h(field: str) -> str:
        return f"(('0x' || substr(md5(CAST(id AS VARCHAR) || ':{field}:{syn.DEFAULT_SEED}'), 1, {syn.DRAW_DIGITS}))::BIGINT)"

    def pick(values, field: str) -> str:
        items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        return f"([{items}])[{h(field)} % {len(values)} + 1]"

    q_low, q_high = schema.GENERATED_QUANTITY_RANGE
    low_cents = round(schema.GENERATED_PRICE_RANGE[0] * 100)
    span = round(schema.GENERATED_PRICE_RANGE[1] * 100) - low_cents + 1
    ts = f"(TIMESTAMP '{syn.DEFAULT_NOW}' - to_seconds({h('date')} % {syn.YEAR_SECONDS}))"
    return f"""
SELECT
  printf('ORD-%08d', id) AS order_id,
  printf('CUST-%06d', {h('customer')} % 1000000) AS customer_id,
  'Customer ' || CAST({h('name')} % 100000 AS VARCHAR) AS customer_name,
  'customer' || CAST({h('name')} % 100000 AS VARCHAR) || '@example.com' AS customer_email,
  {pick(schema.REGIONS, 'region')} AS region,
  'City ' || CAST({h('city')} % 500 AS VARCHAR) AS city,
  'ST' || CAST(({h('city')} % 500) % 27 AS VARCHAR) AS state,
  printf('PROD-%04d', {h('product')} % 10000) AS product_id,
  'Product ' || CAST({h('product')} % 10000 AS VARCHAR) AS product_name,
  {pick(schema.VALID_CATEGORIES, 'category')} AS category,
  quantity,
  price_cents / 100 AS unit_price,
  CAST(pct AS DOUBLE) AS discount_pct,
  discount_cents / 100 AS discount_amount,
  gross_cents / 100 AS gross_revenue,
  (gross_cents - discount_cents) / 100 AS net_revenue,
  {pick(schema.PAYMENT_METHODS, 'payment')} AS payment_method,
  {pick(schema.VALID_STATUSES, 'status')} AS status,
  strftime(ts, {TS}) AS order_date,
  CAST(year(ts) AS INTEGER) AS order_year,
  CAST(month(ts) AS INTEGER) AS order_month,
  CAST(day(ts) AS INTEGER) AS order_day,
  '{syn.DEFAULT_NOW}' AS created_at
FROM (
  SELECT *, quantity * price_cents AS gross_cents,
         (quantity * price_cents * pct + 50) // 100 AS discount_cents
  FROM (
    SELECT id,
      CAST({h('quantity')} % {q_high - q_low + 1} + {q_low} AS INTEGER) AS quantity,
      {h('price')} % {span} + {low_cents} AS price_cents,
      {pick(schema.DISCOUNT_CHOICES, 'discount')} AS pct,
      {ts} AS ts
    FROM (SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem)))"""


def _checks_sql() -> str:
    statuses = _in_list(schema.VALID_STATUSES)
    buckets = _in_list([b for _, b in schema.REVENUE_BUCKETS] + [schema.TOP_BUCKET])
    categories = _in_list(schema.VALID_CATEGORIES)
    labels = _in_list([label for _, label in schema.SEGMENTS] + [schema.LAST_SEGMENT])
    low, high = schema.QUANTITY_RANGE

    def rows(layer: str, table: str, rules: dict[str, str]) -> str:
        aggs = ", ".join(f"CAST({expr} AS BIGINT) AS {name}" for name, expr in rules.items())
        unpivot = " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS rule, {name} AS violations FROM c"
            for name in rules
        )
        return f"(WITH c AS (SELECT {aggs} FROM {table}) {unpivot})"

    parts = [
        rows("bronze", "bronze", {"missing_required_field": f"COUNT(*) FILTER (WHERE NOT ({VALID_COND}))"}),
        rows("silver", "silver", {
            "duplicate_order_id": "COUNT(*) - COUNT(DISTINCT order_id)",
            "status_outside_domain": f"COUNT(*) FILTER (WHERE status IS NOT NULL AND status NOT IN ({statuses}))",
            "non_positive_price": "COUNT(*) FILTER (WHERE unit_price <= 0)",
            "quantity_out_of_range": f"COUNT(*) FILTER (WHERE NOT (quantity BETWEEN {low} AND {high}))",
            "bucket_outside_domain": f"COUNT(*) FILTER (WHERE NOT (revenue_bucket IN ({buckets})))",
            "unknown_category": f"COUNT(*) FILTER (WHERE category IS NOT NULL AND category NOT IN ({categories}))",
        }),
        rows("gold.sales_by_region", "sales_by_region", {
            "negative_revenue": "COUNT(*) FILTER (WHERE total_revenue < 0)",
            "rank_not_starting_at_one": "CASE WHEN COUNT(*) > 0 THEN CAST(MIN(revenue_rank) <> 1 AS INTEGER) ELSE 0 END",
            "duplicate_region_month": "COUNT(*) - COUNT(DISTINCT CASE WHEN region IS NOT NULL AND order_year IS NOT NULL AND order_month IS NOT NULL THEN row(region, order_year, order_month) END)",
        }),
        rows("gold.product_performance", "product_performance", {
            "rank_below_one": "COUNT(*) FILTER (WHERE rank_in_category < 1)",
            "duplicate_product_id": "COUNT(*) - COUNT(DISTINCT product_id)",
        }),
        rows("gold.customer_segments", "customer_segments", {
            "segment_outside_domain": f"COUNT(*) FILTER (WHERE NOT (segment IN ({labels})))",
            "frequency_below_one": "COUNT(*) FILTER (WHERE frequency < 1)",
            "negative_monetary": "COUNT(*) FILTER (WHERE monetary < 0)",
        }),
    ]
    return q(" UNION ALL ".join(f"SELECT * FROM {p}" for p in parts))


def _reasons() -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '{c} is null' END" for c in schema.REQUIRED_COLUMNS
    )
    return f"concat_ws('; ', {parts})"


_MART_COUNTS = " UNION ALL ".join(
    f"SELECT '{m}' AS mart, COUNT(*) AS rows FROM {m}"
    for m in ["sales_by_region", "product_performance", "customer_segments"]
)

ORACLE: dict[str, str] = {
    "csv_scan": q("SELECT * FROM raw"),
    "csv_corrupt_records": _corrupt_sql(),
    "valid_orders": q("SELECT * FROM valid"),
    "quarantined_orders": q(
        f"SELECT *, {_reasons()} AS _quarantine_reasons FROM raw WHERE NOT ({VALID_COND})"
    ),
    "validation_report": q(
        "SELECT COUNT(*) AS total_rows, "
        f"COUNT(*) FILTER (WHERE {VALID_COND}) AS valid_rows, "
        f"COUNT(*) FILTER (WHERE NOT ({VALID_COND})) AS invalid_rows, "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in schema.REQUIRED_COLUMNS
        )
        + " FROM raw"
    ),
    "ingestion_metadata": q(
        "SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, "
        "'s3a://landing/sales/*.csv' AS _source_path, "
        "'2024-01-01T000000' AS _pipeline_run_id FROM valid"
    ),
    "bronze_roundtrip": q("SELECT * FROM bronze"),
    "stream_ingest": q("SELECT * FROM valid"),
    "bronze_append_rerun": q("SELECT * FROM bronze UNION ALL SELECT * FROM bronze"),
    "dedupe_latest": q("SELECT * FROM dedup"),
    "dedupe_removed": q("SELECT * FROM bronze EXCEPT ALL SELECT * FROM dedup"),
    "clean_orders": q(_money("clean")),
    "recomputed_financials": q(
        "SELECT order_id, quantity, " + MONEY_OUT + " FROM clean"
    ),
    "silver_columns": q(_money("silver")),
    "revenue_buckets": q(
        "SELECT revenue_bucket, COUNT(*) AS orders, COUNT(net_revenue) AS priced_orders, "
        "CAST(MIN(net_revenue) AS DOUBLE) AS min_net_revenue, "
        "CAST(MAX(net_revenue) AS DOUBLE) AS max_net_revenue "
        "FROM silver GROUP BY revenue_bucket"
    ),
    "silver_orders": q(_money("silver")),
    "silver_partition_counts": q(
        "SELECT order_year, order_month, category, COUNT(*) AS rows "
        "FROM silver GROUP BY order_year, order_month, category"
    ),
    "completed_orders": q(_money("completed")),
    "sales_by_region": q("SELECT * FROM sales_by_region"),
    "product_performance": q("SELECT * FROM product_performance"),
    "top_products_by_category": q(
        "SELECT * FROM product_performance WHERE rank_in_category <= 10"
    ),
    "rfm_base": q(
        "SELECT customer_id, customer_name, region, last_order_date, frequency, "
        "CAST(monetary AS DOUBLE) AS monetary, recency_days FROM rfm_recency"
    ),
    "rfm_scores": q(
        "SELECT customer_id, customer_name, region, last_order_date, frequency, "
        "CAST(monetary AS DOUBLE) AS monetary, recency_days, r_tile AS r_score, "
        "f_tile AS f_score, m_tile AS m_score, r_tile + f_tile + m_tile AS rfm_score "
        "FROM rfm_tiles"
    ),
    "customer_segments": q("SELECT * FROM customer_segments"),
    "customer_segments_standard": q("SELECT * FROM customer_segments_standard"),
    "segment_distribution": q(
        "SELECT segment, COUNT(*) AS count FROM customer_segments GROUP BY segment"
    ),
    "mart_roundtrip": q(_MART_COUNTS),
    "pipeline_run": q(
        "SELECT 'ingestion' AS step, 'bronze' AS output, COUNT(*) AS records FROM valid "
        "UNION ALL SELECT 'transformation', 'silver', COUNT(*) FROM silver "
        + " ".join(
            f"UNION ALL SELECT 'load', '{m}', COUNT(*) FROM {m}"
            for m in ["sales_by_region", "product_performance", "customer_segments"]
        )
    ),
    "layer_counts": q(
        "SELECT 'raw' AS layer, 'read_rows' AS metric, COUNT(*) AS value FROM raw "
        "UNION ALL SELECT 'raw', 'corrupt_rows', 0 "
        f"UNION ALL SELECT 'raw', 'invalid_rows', COUNT(*) FILTER (WHERE NOT ({VALID_COND})) FROM raw "
        "UNION ALL SELECT 'bronze', 'written_rows', COUNT(*) FROM valid "
        "UNION ALL SELECT 'bronze', 'duplicates_removed', "
        "(SELECT COUNT(*) FROM valid) - (SELECT COUNT(*) FROM silver) "
        "UNION ALL SELECT 'silver', 'written_rows', COUNT(*) FROM silver "
        + " ".join(
            f"UNION ALL SELECT 'gold.{m}', 'written_rows', COUNT(*) FROM {m}"
            for m in ["sales_by_region", "product_performance", "customer_segments"]
        )
    ),
    "layer_checks": _checks_sql(),
    "synthetic_orders": _synthetic_sql(),
}
# What the jobs store from landed files: the same rows, without each run's metadata.
ORACLE["stored_silver"] = (
    f"SELECT * EXCLUDE (_ingested_at, _source_path, _pipeline_run_id) FROM ({ORACLE['silver_orders']})"
)
ORACLE |= {f"stored_{m}": ORACLE[m] for m in ("sales_by_region", "product_performance", "customer_segments")}
ORACLE |= {
    "bronze_commits": ORACLE["bronze_roundtrip"],
    "stored_quarantine": ORACLE["quarantined_orders"],
    "incremental_silver": ORACLE["silver_columns"],
    "bucketed_dedupe": ORACLE["dedupe_latest"],
    "unique_customers": q(
        "SELECT region, order_year, COUNT(DISTINCT customer_id) AS unique_customers FROM completed GROUP BY region, order_year "
        "UNION ALL SELECT '(all)', order_year, COUNT(DISTINCT customer_id) FROM completed GROUP BY order_year"
    ),
}
