"""The registered queries once more as DuckDB SQL over the same tables, written independently.

``list_reduce``, recursive CTEs and list functions stand in for Spark's expressions. Queries
without an entry are checked against plain Python on small tables in ``tests/``.
"""

from __future__ import annotations

# Shared parts ---------------------------------------------------------------------------

_DELIVERIES = """
deliveries AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 0 AS n,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
         strftime(o_orderdate, '%Y-%m-%d') AS load_at
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 1, 'completed',
         strftime(o_orderdate + CASE o_orderstatus WHEN 'F' THEN INTERVAL 1 DAY WHEN 'O' THEN INTERVAL 0 DAY
                                ELSE INTERVAL (-1) DAY END, '%Y-%m-%d')
  FROM orders
),
bronze AS (
  SELECT 'o-' || o_orderkey AS order_id, 'c-' || o_custkey AS customer_id, o_totalprice AS amount, status,
         'BR' AS country, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_ts, load_at,
         o_orderkey * 2 + n AS _ord, o_orderpriority AS priority
  FROM deliveries
)"""

_SILVER = _DELIVERIES + """,
silver AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY load_at DESC, _ord ASC) = 1 AS is_current
  FROM bronze
),
cur AS (SELECT * FROM silver WHERE is_current)"""

_KPI = _SILVER + """,
kpi AS (
  SELECT 'gmv_completed' AS kpi_name, round(coalesce(sum(amount) FILTER (WHERE status = 'completed'), 0), 2) AS kpi_value FROM cur
  UNION ALL SELECT 'active_customers', CAST(count(DISTINCT customer_id) AS DOUBLE) FROM cur
  UNION ALL SELECT 'completion_rate', round(count(*) FILTER (WHERE status = 'completed') / count(*), 4) FROM cur
)"""

_ENTITY = """
wide AS (
  SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
sent AS (SELECT *, unnest([0, 1]) AS n FROM wide),
landing AS (
  SELECT 'b-' || c_custkey AS id, repeat(c_name, 20) AS name,
         CASE WHEN n = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS brewery_type,
         CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'Street ' || c_nationkey END AS address_1,
         CASE WHEN n = 0 THEN n_name END AS city,
         lower(replace(n_name, '_', ' ')) || ' province' AS state_province,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN n = 0 THEN lower(r_name) ELSE r_name END AS country,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS longitude,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS latitude,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE n_name END AS state,
         c_custkey * 2 + n AS _ord
  FROM sent
),
entity AS (
  SELECT id, left(name, 255) AS name, brewery_type, address_1, CAST(NULL AS VARCHAR) AS address_2,
         CAST(NULL AS VARCHAR) AS address_3, city, state_province, CAST(NULL AS VARCHAR) AS postal_code, country,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS website_url, state, CAST(NULL AS VARCHAR) AS street,
         longitude, latitude, _ord
  FROM landing
),
kept AS (SELECT * FROM entity QUALIFY row_number() OVER (PARTITION BY id ORDER BY _ord DESC) = 1),
keyed AS (
  SELECT coalesce(upper(country), 'UNKNOWN') AS p_country,
         replace(upper(coalesce(state, state_province, 'unknown')), ' ', '_') AS p_state, *
  FROM landing
)"""

_DOC_CHUNKS = """
chunks AS (
  SELECT doc_id, 'd' || doc_id AS id, lang AS title, text, source AS source_id, CAST(doc_id % 7 AS INTEGER) AS page,
         lower(lang || ' ' || text || ' ' || source) AS hay
  FROM documents
)"""


def _keyword(queries: str) -> str:
    return f"""
{queries},
words AS (
  SELECT DISTINCT query_id, w FROM (
    SELECT query_id, unnest(string_split_regex(lower(replace(query, '/', ' ')), '\\s+')) AS w FROM asked
  ) WHERE length(w) > 2
),
sizes AS (SELECT query_id, count(*) AS size FROM words GROUP BY query_id),
pairs AS (
  SELECT query_id, id, doc_id, count(*) AS hits
  FROM words JOIN chunks ON contains(hay, w) GROUP BY query_id, id, doc_id
),
kw AS (
  SELECT query_id, id, doc_id, hits / size AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(hits / size, 12) DESC, doc_id) AS rank
  FROM pairs JOIN sizes USING (query_id) QUALIFY rank <= 4
)"""


_BENCH = "asked AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
_KEYWORD = _DOC_CHUNKS + "," + _keyword(_BENCH)

_ASKED_BOTH = """asked AS (
  SELECT item_id AS query_id, text AS query FROM benchmark
  UNION ALL
  SELECT -item_id - 1,
         '#' || replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '0123456789'), ' ', '#') FROM benchmark
)"""

_FOUND = (
    _DOC_CHUNKS
    + ","
    + _keyword(_ASKED_BOTH)
    + """,
hit AS (
  SELECT query_id, query, rank, id, page, title, text,
         trim(replace(text, chr(10), ' ')) AS flat
  FROM kw JOIN chunks USING (id, doc_id) JOIN asked USING (query_id)
)"""
)


def _snip(limit: int) -> str:
    return f"CASE WHEN length(flat) > {limit} THEN rtrim(left(flat, {limit})) || '…' ELSE flat END"


def _bucket_counts(table: str, key: str, text: str) -> str:
    return f"""
    SELECT {key}, bucket, count(*) AS n FROM (
      SELECT {key}, CAST(('0x' || right(md5(w), 2)) AS BIGINT) % 32 AS bucket FROM (
        SELECT {key}, unnest(string_split_regex(lower(replace({text}, '/', ' ')), '\\s+')) AS w FROM {table}
      ) WHERE length(w) > 2
    ) GROUP BY {key}, bucket"""


_TEXT_VECTORS = f"""
qc AS ({_bucket_counts("asked", "query_id", "query")}),
qn AS (SELECT query_id, sqrt(sum(n * n)) AS len FROM qc GROUP BY query_id),
dc AS ({_bucket_counts("chunks", "doc_id", "text")}),
dn AS (SELECT doc_id, sqrt(sum(n * n)) AS len FROM dc GROUP BY doc_id),
dots AS (
  SELECT query_id, doc_id, sum(qc.n * dc.n) AS d FROM qc JOIN dc USING (bucket) GROUP BY query_id, doc_id
),
vec AS (
  SELECT query_id, 'd' || doc_id AS id, doc_id, d / (qn.len * dn.len) AS score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(d / (qn.len * dn.len), 12) DESC, doc_id) AS rank
  FROM dots JOIN qn USING (query_id) JOIN dn USING (doc_id) QUALIFY rank <= 4
)"""

_RULES_EVENTS = """
e AS (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
         CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value,
         CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS event_type
  FROM events
),
s AS (
  SELECT count(*) AS rows, count(*) - count(user_id) AS nulls,
         count(*) FILTER (WHERE value < 0 OR value > 10) AS out10, count(*) FILTER (WHERE value < 0) AS out0,
         count(*) FILTER (WHERE user_id < 0) AS user0,
         count(event_id) - count(DISTINCT event_id) AS dup_id,
         count(*) FILTER (WHERE event_type <> '') - count(DISTINCT nullif(event_type, '')) AS dup_type
  FROM e
)"""


def _report(rows: list[tuple[str, str, str, str]]) -> str:
    parts = [
        f"SELECT {i} AS position, {name} AS name, {passed} AS passed, {message} AS message, "
        f"CAST({first} AS DOUBLE) AS first_metric FROM s"
        for i, (name, passed, message, first) in enumerate(rows, start=1)
    ]
    return "\nUNION ALL ".join(parts)


def _null_row(column: str, nulls: str, limit: float) -> tuple[str, str, str, str]:
    return (
        f"'null_rate:{column}'",
        f"{nulls} / rows <= {limit}",
        f"printf('null rate=%.3f max=%.3f', {nulls} / rows, {limit})",
        "rows",
    )


def _volume_row(base: int, limit: float) -> tuple[str, str, str, str]:
    pct = f"abs(rows - {base}) / {base} * 100"
    return (
        "'volume_vs_baseline'",
        f"{pct} <= {limit}",
        f"printf('variance=%.2f%% max=%.2f%%', {pct}, {limit})",
        "rows",
    )


_ENTITY_GATE = """,
s AS (
  SELECT count(*) AS rows, count(*) - count(id) AS n_id, count(*) - count(name) AS n_name,
         count(*) - count(brewery_type) AS n_type, count(id) - count(DISTINCT id) AS dup FROM {source}
)
"""


def _entity_gate(source: str, minimum: int) -> str:
    return f"WITH {_ENTITY}" + _ENTITY_GATE.format(source=source) + _report(
        [
            _null_row("id", "n_id", 0.0),
            _null_row("name", "n_name", 0.0),
            _null_row("brewery_type", "n_type", 0.0),
            ("'duplicate:id'", "dup = 0", "'duplicate_count=' || dup", "rows"),
            ("'min_volume'", f"rows >= {minimum}", f"'count=' || rows || ' min={minimum}'", "rows"),
        ]
    )


def _declared(table: str, key: str, columns: list[str]) -> str:
    nulls = ", ".join(f"count(*) - count({c}) AS n_{c}" for c in columns)
    rows = [(f"'primary_key:{key}'", "dup = 0", "'duplicate_count=' || dup", "rows")]
    rows += [_null_row(c, f"n_{c}", 0.0) for c in columns]
    distinct = f"({key})" if "," in key else key
    return (
        f"SELECT *, '{table}' AS table_name FROM (WITH s AS (SELECT count(*) AS rows, "
        f"count(*) - count(DISTINCT {distinct}) AS dup, {nulls} FROM {table}) {_report(rows)})"
    )


_COUNTED = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in names)


#: Fixed values of the generated tables: what a row number gives in turn, from remainder 0 on.
CUSTOMER_CITIES = ("Rio de Janeiro", "Sao Paulo", "Belo Horizonte", "Curitiba", "Porto Alegre")
CUSTOMER_STATES = ("RJ", "SP", "MG", "PR", "RS")
SELLER_CITIES = ("Rio de Janeiro", "Sao Paulo", "Salvador", "Recife")
SELLER_STATES = ("RJ", "SP", "BA", "PE")
ORDER_STATES = ("cancelled", "processing", "shipped", *["delivered"] * 7)
PAYMENT_KINDS = ("boleto", "credit_card", "debit_card", "voucher")


def _turn(values: tuple[str, ...]) -> str:
    """The value for row number ``i``, looked up in a list."""
    return f"{list(values)}[i % {len(values)} + 1]"


def _padded(prefix: str, number: str, width: int) -> str:
    return (
        f"'{prefix}' || CASE WHEN length(CAST({number} AS VARCHAR)) >= {width} THEN CAST({number} AS VARCHAR) "
        f"ELSE lpad(CAST({number} AS VARCHAR), {width}, '0') END"
    )


def _stamp(start: str, shift: str) -> str:
    return f"strftime(TIMESTAMP '{start}' + {shift}, '%Y-%m-%d %H:%M:%S')"


_MIN = "to_minutes(i * 17)"
_PAGED_BODY = """
lines AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) AS INTEGER) AS page, unnest(l) AS raw FROM (
    SELECT doc_id, string_split(replace(text, chr(10), chr(12)), chr(12)) AS l FROM documents
  )
),
bodies AS (
  SELECT doc_id, page,
         trim(array_to_string(list_transform(
           string_split(replace(replace(raw, '. ', '. ' || chr(13) || chr(10) || chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(10)),
           lambda x: rtrim(x)), chr(10)), ' ' || chr(10)) AS body
  FROM lines
)"""

_COLS = "query_id, id, CAST(rank AS INTEGER) AS rank, round(round(score, 12), 9) AS score"

ORACLES: dict[str, str] = {
    "orders_bronze": f"WITH {_DELIVERIES} SELECT * FROM bronze",
    "orders_silver": f"WITH {_SILVER} SELECT * FROM silver",
    "orders_versions_sorted": f"WITH {_DELIVERIES} SELECT order_id, load_at, _ord, status FROM bronze ORDER BY order_id DESC, load_at DESC, _ord",
    "orders_latest": f"WITH {_DELIVERIES} SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ord DESC) = 1",
    "shop_orders_bronze": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS order_status,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
               CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_approved_at,
               CASE WHEN o_orderstatus = 'F' THEN strftime(date_trunc('day', o_orderdate) + INTERVAL 5 DAY, '%Y-%m-%d %H:%M:%S') END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN strftime(date_trunc('day', o_orderdate) + INTERVAL 5 DAY, '%Y-%m-%d %H:%M:%S') END AS order_delivered_customer_date,
               strftime(date_trunc('day', o_orderdate) + INTERVAL 5 DAY, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
        FROM orders""",
    "entity_bronze": f"WITH {_ENTITY} SELECT * FROM entity",
    "entity_silver": f"WITH {_ENTITY} SELECT * FROM kept",
    "kpi_orders_daily": f"WITH {_KPI} SELECT kpi_name, kpi_value, 'BR' AS country, 'daily' AS grain FROM kpi",
    "kpi_metric_spec": f"""WITH {_SILVER}
        SELECT priority, unnest(['gmv_completed', 'gmv', 'active_customers', 'completing_customers', 'completion_rate']) AS kpi_name,
               unnest([round(coalesce(sum(amount) FILTER (WHERE status = 'completed'), 0), 2), round(sum(amount), 2),
                       CAST(count(DISTINCT customer_id) AS DOUBLE),
                       CAST(count(DISTINCT customer_id) FILTER (WHERE status = 'completed') AS DOUBLE),
                       round(count(*) FILTER (WHERE status = 'completed') / count(*), 4)]) AS kpi_value
        FROM cur GROUP BY priority""",
    "completed_orders": f"WITH {_SILVER} SELECT order_id, amount, load_at FROM cur WHERE status = 'completed'",
    "analytics_export": f"WITH {_KPI} SELECT kpi_name, kpi_value, 'BR' AS country, 'analytics' AS export_channel FROM kpi",
    "export_gate": f"""WITH {_KPI},
        s AS (SELECT count(*) AS rows, count(*) - count(kpi_name) AS n_name, count(*) - count(kpi_value) AS n_value,
                     count(*) FILTER (WHERE kpi_value < 0) AS low FROM kpi)
        """
    + _report(
        [
            _null_row("kpi_name", "n_name", 0.0),
            _null_row("kpi_value", "n_value", 0.0),
            ("'range:kpi_value'", "low = 0", "'violations=' || low", "low"),
            _volume_row(3, 0.0),
        ]
    ),
    "layer_row_stats": f"""WITH {_SILVER}
        SELECT unnest(['landing', 'bronze', 'silver', 'gold', 'export', 'current']) AS step,
               unnest([count(*), count(*), count(*), 3, 3, count(*) FILTER (WHERE is_current)]) AS rows FROM silver""",
    "filter_rules": """
        SELECT 'customer_' || c_mktsegment AS output, c_custkey, ' ' || c_mktsegment AS c_mktsegment
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "filter_outputs": """
        SELECT 'customer_BUILDING' AS table_name, count(*) AS rows, count(*) AS written FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'customer_NONE', count(*), count(*) FROM customer WHERE c_mktsegment = 'NONE'""",
    "partition_keys": f"WITH {_ENTITY} SELECT p_country, p_state, '2024-01-30' AS load_date, count(*) AS rows FROM keyed GROUP BY p_country, p_state",
    "partition_roundtrip": f"""WITH {_ENTITY}
        SELECT id, coalesce(upper(country), 'UNKNOWN') AS p_country,
               replace(upper(coalesce(state, state_province, 'unknown')), ' ', '_') AS p_state,
               '2024-01-30' AS load_date, longitude FROM kept""",
    "partition_inventory": f"""WITH {_ENTITY}
        SELECT count(*) AS partitions, CAST(sum(n) AS BIGINT) AS total_rows
        FROM (SELECT count(*) AS n FROM keyed GROUP BY p_country, p_state)""",
    "date_window": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-24' AND DATE '2024-01-30' GROUP BY day, event_type""",
    "csv_roundtrip": "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations",
    "csv_cloud_roundtrip": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
    "json_roundtrip": "SELECT *, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS s_rating FROM supplier",
    "parquet_roundtrip": "SELECT * FROM customer",
    "typed_copy": """
        SELECT l_returnflag, strftime(l_shipdate, '%Y') AS year, count(*) AS rows,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) AS DOUBLE) AS price, sum(l_quantity) AS quantity,
               max(l_orderkey) AS last_order, CAST(sum(l_linenumber) AS BIGINT) AS lines
        FROM lineitem GROUP BY l_returnflag, year""",
    "publish_text": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier",
    "publish_summary": f"""
        WITH c AS (
          SELECT table_name, rows, ['bronze', 'silver'] AS l FROM ({_counts(_COUNTED)})
          UNION ALL SELECT 'customer_BUILDING', count(*), ['silver', 'gold'] FROM customer WHERE c_mktsegment = 'BUILDING'
        ), p AS (SELECT unnest(l) AS layer, table_name, rows FROM c)
        SELECT * FROM p UNION ALL SELECT 'all', 'total', CAST(sum(rows) AS BIGINT) FROM p""",
    "layer_counts": _counts(_COUNTED),
    "json_list_roundtrip": "SELECT * FROM supplier",
    "csv_inferred": "SELECT p_partkey, p_name, p_size, round(p_retailprice, 2) AS p_retailprice, 'p_partkey:int,p_name:string,p_brand:string,p_type:string,p_size:int,p_retailprice:double' AS kinds FROM part",
    "shop_flow": """
        SELECT 'processing/customer' AS place, count(*) AS rows FROM customer UNION ALL SELECT 'processing/orders', count(*) FROM orders
        UNION ALL SELECT 'processing/nation', count(*) FROM nation
        UNION ALL SELECT 'filtered/customer_building', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'gold/open', count(*) FROM orders WHERE o_orderstatus = 'O'""",
    "table_exports": _counts(_COUNTED),
    "catalog_tables": f"""
        SELECT table_name || '_pqt' AS table_name, rows FROM ({_counts(_COUNTED)})
        UNION ALL SELECT 'customer_BUILDING_csv', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "lake_inventory": f"SELECT *, true AS exists FROM ({_counts(_COUNTED)}) UNION ALL SELECT 'gold/missing', 0, false",
    "entity_layers": """
        SELECT unnest(['landing', 'bronze', 'silver', 'gold']) AS layer,
               unnest([2 * count(*), 2 * count(*), count(*), count(*)]) AS rows FROM customer""",
    "dq_report": f"WITH {_RULES_EVENTS} "
    + _report(
        [
            _null_row("event_id", "0", 0.0),
            _null_row("user_id", "nulls", 0.05),
            _null_row("user_id", "nulls", 0.9),
            _null_row("nowhere", "rows", 0.0),
            ("'range:value'", "out10 = 0", "'violations=' || out10", "out10"),
            ("'range:value'", "out0 = 0", "'violations=' || out0", "out0"),
            ("'range:user_id'", "user0 = 0", "'violations=' || user0", "user0"),
            _volume_row(12000, 20.0),
            _volume_row(100, 5.0),
            ("'volume_vs_baseline'", "false", "'baseline must be > 0'", "rows"),
            ("'duplicate:event_id'", "dup_id = 0", "'duplicate_count=' || dup_id", "rows"),
            ("'duplicate:event_type'", "dup_type = 0", "'duplicate_count=' || dup_type", "rows"),
            ("'min_volume'", "rows >= 100", "'count=' || rows || ' min=100'", "rows"),
        ]
    ),
    "dq_silver_gate": _entity_gate("kept", 1),
    "dq_bronze_duplicates": _entity_gate("entity", 10**9),
    "pk_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "declared_rules": _declared("orders", "o_orderkey", ["o_custkey", "o_orderdate"])
    + " UNION ALL "
    + _declared("lineitem", "l_orderkey,l_linenumber", ["l_suppkey"]),
    "fk_orphans": """
        SELECT l_orderkey AS orphan_key, count(*) AS row_count FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
    "unlabelled_documents": """
        SELECT doc_id AS orphan_key, count(*) AS row_count FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "distinct_customers_card": "SELECT count(DISTINCT o_custkey) AS distinct_count FROM orders",
    "customers_by_nation": "SELECT n_name, count(*) AS row_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "bi_join": """
        SELECT c_custkey, c_name, t.orders, t.spent FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey) t
        ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'""",
    "seed_customers": f"""
        SELECT {_padded("cust-", "i", 4)} AS customer_id, {_padded("uniq-", "i", 4)} AS customer_unique_id,
               lpad(CAST((10000 + i) % 90000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               {_turn(CUSTOMER_CITIES)} AS customer_city, {_turn(CUSTOMER_STATES)} AS customer_state
        FROM (SELECT c_custkey + 1 AS i FROM customer)""",
    "seed_sellers": f"""
        SELECT {_padded("sell-", "i", 3)} AS seller_id, lpad(CAST((20000 + i) % 90000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               {_turn(SELLER_CITIES)} AS seller_city, {_turn(SELLER_STATES)} AS seller_state
        FROM (SELECT s_suppkey + 1 AS i FROM supplier)""",
    "seed_orders": f"""
        SELECT {_padded("ord-", "i", 5)} AS order_id, {_padded("cust-", "((i - 1) % 300 + 1)", 4)} AS customer_id,
               {_turn(ORDER_STATES)} AS order_status,
               {_stamp("2017-01-01", _MIN)} AS order_purchase_timestamp,
               {_stamp("2017-01-01", "to_minutes(i * 17 + 10)")} AS order_approved_at,
               CASE WHEN i % 10 NOT IN (0, 1) THEN {_stamp("2017-01-01", _MIN + " + to_days(CAST(i % 7 + 1 AS INTEGER))")} END AS order_delivered_carrier_date,
               CASE WHEN i % 10 NOT IN (0, 1, 2) THEN {_stamp("2017-01-01", _MIN + " + to_days(CAST(i % 14 + 3 AS INTEGER))")} END AS order_delivered_customer_date,
               {_stamp("2017-01-01", _MIN + " + to_days(CAST(i % 21 + 7 AS INTEGER))")} AS order_estimated_delivery_date
        FROM (SELECT o_orderkey + 1 AS i FROM orders)""",
    "seed_items": f"""
        SELECT {_padded("ord-", "i", 5)} AS order_id, 1 AS order_item_id, {_padded("prod-", "(i % 500 + 1)", 5)} AS product_id,
               {_padded("sell-", "((i - 1) % 20 + 1)", 3)} AS seller_id,
               {_stamp("2017-01-01", _MIN + " + to_days(3)")} AS shipping_limit_date,
               CAST(20.0 + (i % 97) * 3.75 AS DOUBLE) AS price, CAST(5.0 + (i % 11) * 1.25 AS DOUBLE) AS freight_value
        FROM (SELECT o_orderkey + 1 AS i FROM orders)""",
    "seed_payments": f"""
        SELECT {_padded("ord-", "i", 5)} AS order_id, 1 AS payment_sequential,
               {_turn(PAYMENT_KINDS)} AS payment_type,
               CAST(CASE WHEN i % 4 = 1 THEN i % 6 + 1 ELSE 1 END AS INTEGER) AS payment_installments,
               CAST(CAST(25.0 + (i % 97) * 4.10 AS DECIMAL(10, 2)) AS DOUBLE) AS payment_value
        FROM (SELECT o_orderkey + 1 AS i FROM orders)""",
    "seed_reviews": f"""
        SELECT {_padded("rev-", "i", 5)} AS review_id, {_padded("ord-", "i", 5)} AS order_id,
               CAST(i % 5 + 1 AS SMALLINT) AS review_score,
               CASE WHEN i % 3 <> 0 THEN 'Title ' || i END AS review_comment_title,
               CASE WHEN i % 4 <> 0 THEN 'Review message for order ' || i END AS review_comment_message,
               {_stamp("2017-06-01", "to_days(CAST(i % 30 + 1 AS INTEGER))")} AS review_creation_date,
               CASE WHEN i % 2 = 0 THEN {_stamp("2017-06-01", "to_days(CAST(i % 30 + 2 AS INTEGER))")} END AS review_answer_timestamp
        FROM (SELECT o_orderkey + 1 AS i FROM orders)""",
    "page_cut": """
        WITH n AS (SELECT user_id + 1 AS page, count(*) AS n FROM events GROUP BY page),
        stop AS (
          SELECT min(p) AS cut FROM (
            SELECT page AS p FROM n WHERE n < 50
            UNION ALL SELECT page + 1 FROM n WHERE page + 1 NOT IN (SELECT page FROM n)
            UNION ALL SELECT 1 WHERE 1 NOT IN (SELECT page FROM n))
        )
        SELECT event_id, user_id + 1 AS page FROM events, stop WHERE user_id + 1 <= cut""",
    "required_fields": """
        SELECT event_type, missing, count(*) AS rows FROM (
          SELECT event_type, CASE WHEN event_type = 'click' THEN '' ELSE 'id,name' END AS missing FROM events
        ) GROUP BY event_type, missing""",
    "llm_json_extract": """
        SELECT item_id, shape, CASE WHEN shape <> 'broken' THEN trim(text) END AS claim,
               CASE WHEN shape <> 'broken' THEN 'a' || chr(10) || trim(string_split(text, chr(10))[1]) END AS evidence
        FROM (SELECT *, unnest(['fenced', 'prose', 'bare', 'broken']) AS shape FROM benchmark)""",
    "route_extract": """
        SELECT conv_id, turn, tool, CASE WHEN tool IS NOT NULL THEN trim(text, ' ' || chr(10)) END AS query,
               CASE WHEN tool = 'feedback' THEN true WHEN tool IS NOT NULL THEN length(text) % 2 = 0 END AS feedback_positive
        FROM (SELECT *, CASE turn WHEN 0 THEN 'ask' WHEN 2 THEN 'feedback' WHEN 4 THEN 'quote' END AS tool
              FROM conversations WHERE role = 'user')""",
    "prompt_fingerprint": "SELECT item_id, left(sha256(trim(text, ' ' || chr(10))), 12) AS prompt_sha FROM benchmark",
    "storage_uris": r"""
        SELECT page_id, CASE WHEN m THEN 'landing' END AS container,
               CASE WHEN m THEN regexp_extract(url, '^https?://([^./]+)\.', 1) END AS account,
               CASE WHEN m THEN nullif(regexp_extract(url, '^https?://[^/]*/([\s\S]*)$', 1), '') END AS path
        FROM (SELECT *, regexp_matches(url, '^https?://[^./]+\.[^/]*/') AS m FROM pages)""",
    "chunk_documents": """
        WITH body AS (
          SELECT doc_id, source, trim(array_to_string(list_transform(string_split(text, chr(10)), lambda x: rtrim(x)), chr(10)), ' ' || chr(10)) AS body
          FROM documents
        ), piece AS (
          SELECT *, unnest(CASE WHEN length(body) <= 1200 THEN [0] ELSE range(0, length(body), 1020) END) AS start FROM body
        ), cut AS (
          SELECT *, substring(body, start + 1, 1200) AS text FROM piece WHERE length(body) >= 80
        ), numbered AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) AS serial FROM cut WHERE length(text) >= 80
        )
        SELECT 'd' || doc_id || '-p1-' || serial AS id, 'd' || doc_id AS source_id, source || '.txt' AS source_path,
               left(trim(string_split(body, chr(10))[1]), 120) AS title, 1 AS page, text, CAST(serial AS INTEGER) AS serial
        FROM numbered""",
    "whole_text_chunks": """
        WITH book AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
        body AS (
          SELECT conv_id, trim(array_to_string(list_transform(string_split(text, chr(10)), lambda x: rtrim(x)), chr(10)), ' ' || chr(10)) AS body FROM book
        ), piece AS (
          SELECT *, unnest(CASE WHEN length(body) <= 1200 THEN [0] ELSE range(0, length(body), 1020) END) AS start FROM body
        ), cut AS (
          SELECT *, substring(body, start + 1, 1200) AS text FROM piece WHERE length(body) >= 80
        )
        SELECT conv_id, '1-' || row_number() OVER (PARTITION BY conv_id ORDER BY start) AS place, md5(text) AS text_md5, 32 AS dimensions
        FROM cut WHERE length(text) >= 80""",
    "page_split": f"""WITH {_PAGED_BODY},
        kept AS (SELECT * FROM bodies WHERE body <> ''),
        blank AS (SELECT doc_id, 1 AS page, '' AS body FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM kept))
        SELECT doc_id, page, CAST(length(body) AS INTEGER) AS chars, md5(body) AS body_md5 FROM (SELECT * FROM kept UNION ALL SELECT * FROM blank)""",
    "chunk_pages": f"""WITH {_PAGED_BODY},
        paras AS (
          SELECT doc_id, page, body,
                 list_filter(list_transform(string_split(body, chr(10) || chr(10)), lambda p: trim(p, ' ' || chr(10))), lambda p: p <> '') AS ps
          FROM bodies WHERE length(body) >= 20
        ),
        runs AS (
          SELECT doc_id, page, body, string_split(list_reduce(ps, lambda acc, p:
            CASE WHEN length(string_split(acc, chr(1))[-1]) + 2 + length(p) <= 200
                 THEN acc || chr(10) || chr(10) || p ELSE acc || chr(1) || p END), chr(1)) AS segs
          FROM paras
        ),
        seg AS (SELECT doc_id, page, body, generate_subscripts(segs, 1) AS k, unnest(segs) AS s FROM runs),
        piece AS (
          SELECT *, unnest(CASE WHEN length(s) <= 200 THEN [0] ELSE range(0, length(s), 160) END) AS start FROM seg
        ),
        cut AS (SELECT *, substring(s, start + 1, 200) AS text FROM piece),
        numbered AS (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, k, start) AS serial FROM cut WHERE length(text) >= 20
        )
        SELECT 'd' || doc_id || '-p' || page || '-' || serial AS id, 'd' || doc_id AS source_id, source || '.txt' AS source_path,
               left(trim(string_split(body, chr(10))[1]), 120) AS title, page, numbered.text, CAST(serial AS INTEGER) AS serial
        FROM numbered JOIN documents USING (doc_id)""",
    "chunk_projection": """
        SELECT CAST(doc_id AS VARCHAR) AS id, '' AS source_id, '' AS source_path,
               CASE WHEN quality = 1 THEN 'good' ELSE '' END AS title, '' AS text, CASE WHEN toxic = 1 THEN 3 ELSE 0 END AS page FROM labels""",
    "hashed_embeddings": f"""
        WITH c AS ({_bucket_counts("documents", "doc_id", "text")})
        SELECT doc_id, CAST(bucket AS INTEGER) AS dimension, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 9) AS weight FROM c""",
    "keyword_topk": f"WITH {_KEYWORD} SELECT {_COLS} FROM kw",
    "keyword_index_topk": f"WITH {_KEYWORD} SELECT {_COLS} FROM kw",
    "vector_topk": """
        WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
        q AS (SELECT label AS query_id, pos, avg(v) AS v FROM x GROUP BY label, pos),
        ql AS (SELECT query_id, sqrt(sum(v * v)) AS len FROM q GROUP BY query_id),
        xl AS (SELECT vec_id, sqrt(sum(v * v)) AS len FROM x GROUP BY vec_id),
        d AS (SELECT query_id, vec_id, sum(q.v * x.v) AS d FROM q JOIN x USING (pos) GROUP BY query_id, vec_id)
        SELECT query_id, CAST(vec_id AS VARCHAR) AS id, CAST(rank AS INTEGER) AS rank, round(round(score, 12), 9) AS score FROM (
          SELECT query_id, vec_id, d / (ql.len * xl.len) AS score,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(d / (ql.len * xl.len), 12) DESC, vec_id) AS rank
          FROM d JOIN ql USING (query_id) JOIN xl USING (vec_id)
        ) WHERE rank <= 4 AND score > 0""",
    "vector_topk_gaps": """
        WITH x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
        q AS (SELECT label AS query_id, pos, avg(v) AS v FROM x GROUP BY label, pos),
        ql AS (SELECT query_id, sqrt(sum(v * v)) AS len FROM q GROUP BY query_id),
        xl AS (SELECT vec_id, sqrt(sum(v * v)) AS len FROM x GROUP BY vec_id),
        d AS (SELECT query_id, vec_id, sum(q.v * x.v) AS d FROM q JOIN x USING (pos) GROUP BY query_id, vec_id)
        SELECT query_id, CAST(vec_id AS VARCHAR) AS id, CAST(rank AS INTEGER) AS rank, round(round(score, 12), 9) AS score FROM (
          SELECT query_id, vec_id, d / (ql.len * xl.len) AS score,
                 row_number() OVER (PARTITION BY query_id ORDER BY round(d / (ql.len * xl.len), 12) DESC, vec_id) AS rank
          FROM d JOIN ql USING (query_id) JOIN xl USING (vec_id) JOIN embeddings e USING (vec_id) WHERE e.label <> 3
        ) WHERE rank <= 4 AND score > 0""",
    "text_vector_topk": f"WITH {_DOC_CHUNKS}, {_BENCH}, {_TEXT_VECTORS} SELECT {_COLS} FROM vec",
    "hybrid_topk": f"""WITH {_KEYWORD}, {_TEXT_VECTORS},
        pool AS (
          SELECT query_id, id, doc_id, sum(1.0::DOUBLE / (60 + rank)) AS score
          FROM (SELECT query_id, id, doc_id, rank FROM kw UNION ALL SELECT query_id, id, doc_id, rank FROM vec)
          GROUP BY query_id, id, doc_id
        )
        SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) AS INTEGER) AS rank,
               round(round(score, 12), 9) AS score FROM pool
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) <= 4""",
    "vector_upsert": """
        WITH x AS (SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dimension, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
        SELECT vec_id, label, dimension, round(CASE WHEN label = 3 THEN -v ELSE v END, 6) AS x FROM x
        UNION ALL SELECT -vec_id - 1, label, dimension, round(-v, 6) FROM x WHERE label = 3""",
    "retrieval_cards": f"""WITH {_FOUND},
        c AS (
          SELECT query_id, 'Pergunta: ' || any_value(query) || chr(10) || chr(10) || 'Segundo o livro:' || chr(10) ||
                 string_agg('- p.' || page || ' [' || id || ']: ' || {_snip(360)}, chr(10) ORDER BY rank) AS answer,
                 string_agg(id || ':' || page, ',' ORDER BY rank) AS cited
          FROM hit GROUP BY query_id
        )
        SELECT query_id, coalesce(answer, 'O livro não cobre este assunto nos trechos indexados.') AS answer,
               coalesce(cited, '') AS cited, answer IS NOT NULL AS covered, answer IS NOT NULL AS offer_example
        FROM asked LEFT JOIN c USING (query_id)""",
    "example_cards": f"""WITH {_FOUND},
        c AS (
          SELECT query_id, 'Contexto: ' || any_value(query) || ' no dia a dia de engenharia de dados.' || chr(10) || chr(10) ||
                 'Situação: um time aplica o conceito do livro neste cenário:' || chr(10) ||
                 string_agg('- p.' || page || ': ' || {_snip(280)}, chr(10) ORDER BY rank) AS scenario
          FROM hit GROUP BY query_id
        )
        SELECT query_id, coalesce(scenario, 'O livro não cobre este assunto nos trechos indexados.') AS scenario,
               scenario IS NOT NULL AS covered FROM asked LEFT JOIN c USING (query_id)""",
    "quote_cards": f"""WITH {_FOUND}
        SELECT query_id, CAST(rank - 1 AS INTEGER) AS position, id AS chunk_id, page, md5(text) AS text_md5, rank IS NOT NULL AS covered
        FROM asked LEFT JOIN hit USING (query_id)""",
    "notes": f"""WITH {_FOUND},
        c AS (
          SELECT query_id, any_value(query) || ': ' || first({_snip(220)} ORDER BY rank) AS claim,
                 md5(string_agg('[p.' || page || '] ' || text, chr(10) || chr(10) ORDER BY rank)) AS evidence_md5,
                 coalesce(array_to_string(list_sort(list_distinct(list(page) FILTER (WHERE page <> 0))), ', '), 'n/a') AS pages,
                 string_agg(id, ',' ORDER BY rank) AS chunk_ids
          FROM hit GROUP BY query_id
        ), k AS (SELECT *, row_number() OVER (ORDER BY query_id) + (SELECT count(*) FROM region) AS n FROM c)
        SELECT query_id, {_padded("NOTE-", "n", 4)} AS note_key, claim, evidence_md5, pages, chunk_ids FROM k""",
    "prompt_context": f"""WITH {_FOUND},
        c AS (
          SELECT query_id, string_agg('### p.' || page || ' ' || title || ' (' || id || ')' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS t
          FROM hit GROUP BY query_id
        )
        SELECT query_id, md5(coalesce(t, '')) AS context_md5 FROM asked LEFT JOIN c USING (query_id)""",
    "last_turn": """
        SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, left(arg_max(text, turn), 800) AS snippet
        FROM conversations GROUP BY conv_id""",
    "preference_profile_few": """
        WITH p AS (SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'error'),
        f AS (SELECT user_id, event_type, min(event_id) AS first FROM p GROUP BY user_id, event_type)
        SELECT user_id, positive_count, likes FROM
          (SELECT user_id, count(*) AS positive_count FROM p GROUP BY user_id)
          JOIN (SELECT user_id, string_agg(event_type, '|' ORDER BY first) AS likes FROM f GROUP BY user_id) USING (user_id)""",
    "trace_summary": r"""
        SELECT role || '.v1' AS prompt_id, count(*) AS calls, CAST(sum(w) AS BIGINT) AS tokens_in,
               CAST(coalesce(sum(w) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS tokens_out,
               round(avg(length(text)), 6) AS avg_elapsed_ms, CAST(max(length(text)) AS INTEGER) AS max_elapsed_ms
        FROM (SELECT *, length(string_split_regex(text, '\s+')) AS w FROM conversations) GROUP BY role""",
    "last_trace": r"""
        SELECT conv_id, turn, role || '.v1' AS prompt_id, left(sha256(trim(text, ' ' || chr(10))), 12) AS prompt_sha,
               'expand>retrieve>ask' AS steps, CAST(length(string_split_regex(text, '\s+')) AS INTEGER) AS tokens_in
        FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "stream_dedupe": "SELECT DISTINCT * FROM events",
    "stream_dedupe_watermark": "SELECT DISTINCT * FROM events",
    "stream_incremental": """
        SELECT 'u-' || user_id AS id, upper(event_type) AS kind, event_id AS _ord, strftime(ts, '%Y-%m-%d') AS load_date
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1""",
}

# Folds and evaluations ------------------------------------------------------------------

_WEAK = """(length(words) > 0 AND (starts_with(lower(now), 'e ') OR starts_with(lower(now), 'and ')
   OR starts_with(lower(now), 'também ') OR starts_with(lower(now), 'tambem ')
   OR (NOT (contains(now, '?') AND length(words) >= 4) AND length(words) <= 4)))"""

# Each turn's history is folded anew; the first letter of an item tells weak from strong.
_FOLLOW = f"""
u AS (
  SELECT conv_id, turn, text, string_split_regex(text, '\\s+') AS w, length(text) % 4 AS kind
  FROM conversations WHERE role = 'user'
),
m AS (
  SELECT conv_id, turn * 2 AS turn, text AS message FROM u
  UNION ALL
  SELECT conv_id, turn * 2 + 1, CASE kind WHEN 0 THEN array_to_string(w[1:2], ' ') WHEN 1 THEN 'explica melhor'
                                          WHEN 2 THEN 'E ' || text ELSE '  ' END FROM u
),
t AS (
  SELECT *, trim(message, ' ' || chr(10)) AS now,
         list_filter(string_split_regex(replace(trim(message, ' ' || chr(10)), '?', ' '), '\\s+'), lambda x: x <> '') AS words
  FROM m
),
k AS (SELECT *, CASE WHEN now = '' THEN 'b' WHEN {_WEAK} THEN 'w' ELSE 's' END || now AS tagged, {_WEAK} AS weak FROM t),
h AS (SELECT *, list(tagged) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS hist FROM k),
b AS (
  SELECT *, list_reduce(hist, lambda acc, x:
    CASE WHEN x = 'b' THEN acc
         WHEN x[1] = 's' OR length(acc) = 1 OR contains(lower(substr(x, 2)), lower(trim(substr(acc, 2), ' ' || chr(10)))) THEN x
         ELSE 'w' || left(trim(substr(acc, 2), ' ' || chr(10)) || '. ' || substr(x, 2), 500) END) AS topic FROM h
),
p AS (SELECT *, CASE WHEN now = '' THEN '' ELSE substr(topic, 2) END AS bound_query,
        trim(lag(substr(topic, 2), 1, '') OVER (PARTITION BY conv_id ORDER BY turn), ' ' || chr(10)) AS prior FROM b)"""

_EVAL = f"""WITH {_FOUND},
agg AS (
  SELECT query_id, list_sort(list_distinct(list(page))) AS cited,
         string_agg(text, ' ' ORDER BY rank) AS quoted, first({_snip(220)} ORDER BY rank) AS s220,
         string_agg('[p.' || page || '] ' || text, chr(10) || chr(10) ORDER BY rank) AS evidence,
         string_agg('- p.' || page || ' [' || id || ']: ' || {_snip(360)}, chr(10) ORDER BY rank) AS lines
  FROM hit GROUP BY query_id
),
cases AS (
  SELECT query_id, query, length(query) % 3 AS kind, query_id >= 0 AS wanted, cited IS NOT NULL AS covered,
         CASE WHEN length(query) % 3 = 1 THEN [] ELSE coalesce(cited, []) END AS cited,
         CASE WHEN query_id >= 0 THEN list_distinct([query_id % 7, query_id % 3]) ELSE [] END AS pages,
         [lower(string_split(query, ' ')[1]), 'no such term'] AS terms, length(query) % 2 = 0 AS cite,
         lower(CASE WHEN cited IS NULL THEN CASE length(query) % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' ELSE 'O livro' END
              WHEN length(query) % 3 = 0 THEN quoted
              WHEN length(query) % 3 = 1 THEN query || ': ' || s220 || ' ' || evidence
              ELSE 'Pergunta: ' || query || chr(10) || chr(10) || 'Segundo o livro:' || chr(10) || lines END) AS body
  FROM asked LEFT JOIN agg USING (query_id)
),
judged AS (
  SELECT query_id, list_filter([
    CASE WHEN covered <> wanted THEN 'covered=' || CASE WHEN covered THEN 'True' ELSE 'False' END || ' expected ' ||
         CASE WHEN wanted THEN 'True' ELSE 'False' END END,
    CASE WHEN NOT list_has_all(cited, pages) THEN 'missing pages [' ||
         array_to_string(list_sort(list_filter(pages, lambda x: NOT list_contains(cited, x))), ', ') || '] in [' ||
         array_to_string(cited, ', ') || ']' END,
    CASE WHEN wanted AND NOT (contains(body, terms[1]) OR contains(body, terms[2]))
         THEN 'missing terms [' || chr(39) || terms[1] || chr(39) || ', ' || chr(39) || terms[2] || chr(39) || '] in answer' END,
    CASE WHEN wanted AND cite AND NOT contains(body, 'p.') THEN 'answer missing page citation (p.N)' END,
    CASE WHEN NOT wanted AND kind = 2 AND covered THEN 'uncovered topic must use the uncovered string' END
  ], lambda x: x IS NOT NULL) AS errors FROM cases
)"""

ORACLES["retrieval_eval"] = f"""{_EVAL}
    SELECT query_id, length(errors) = 0 AS ok, array_to_string(errors, ' | ') AS errors FROM judged"""
ORACLES["eval_pass_rate"] = f"""{_EVAL}
    SELECT count(*) AS cases, count(*) FILTER (WHERE length(errors) = 0) AS passed,
           round(count(*) FILTER (WHERE length(errors) = 0) / count(*), 6) AS rate FROM judged"""
ORACLES["followup_binding"] = f"""WITH {_FOLLOW}
    SELECT conv_id, turn, message, bound_query,
           CASE WHEN NOT weak OR now = '' OR prior = '' THEN false
                WHEN contains(lower(now), lower(prior)) THEN lower(now) <> lower(prior) ELSE true END AS followup FROM p"""
ORACLES["preference_profile"] = """
    WITH f AS (
      SELECT user_id, event_id, event_type || ' ' || json_extract_string(props, '$.k') AS c,
             CASE WHEN value > 20 THEN 'long' END AS length,
             CASE WHEN event_type <> 'click' THEN event_type END AS tone
      FROM events WHERE event_type <> 'error'
    ), g AS (
      SELECT user_id, count(*) AS positive_count, max(event_id) AS updated_at,
             coalesce(arg_max(length, event_id) FILTER (WHERE length IS NOT NULL), 'medium') AS length,
             coalesce(arg_max(tone, event_id) FILTER (WHERE tone IS NOT NULL), 'practical') AS tone,
             list_reduce(list(c ORDER BY event_id), lambda acc, x:
               CASE WHEN list_contains(string_split(acc, '|'), x) THEN acc
                    WHEN length(string_split(acc, '|')) >= 8 THEN array_to_string(list_append(string_split(acc, '|')[2:], x), '|')
                    ELSE acc || '|' || x END) AS likes
      FROM f GROUP BY user_id
    )
    SELECT *, 'User style (from positive feedback — follow this):' || chr(10) || '- length: ' || length || chr(10) ||
           '- tone: ' || tone || chr(10) || '- always cite pages' || chr(10) ||
           array_to_string(list_transform(string_split(likes, '|')[-5:], lambda x: '- ' || x), chr(10)) AS style_block FROM g"""
ORACLES["custom_embeddings"] = ORACLES["hashed_embeddings"]
ORACLES["label_cosine"] = """
    WITH x AS (
      SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings
    ),
    m AS (SELECT label, pos, avg(v) AS v FROM x GROUP BY label, pos)
    SELECT vec_id, round(sum(x.v * m.v) / (sqrt(sum(x.v * x.v)) * sqrt(sum(m.v * m.v))), 9) AS cosine
    FROM x JOIN m USING (label, pos) GROUP BY vec_id"""
ORACLES["hybrid_stored_topk"] = ORACLES["hybrid_topk"]
# The same rows by another way.
ORACLES["vector_groups_topk"] = ORACLES["vector_topk"]
ORACLES["bucket_upsert"] = ORACLES["vector_upsert"]
