"""Plain SQL with the same answers as ``plans.queries``, for a second engine.

Written from the meaning of each operator, not from its Spark plan.
"""

from __future__ import annotations

from mirrorwell.functions.hashing import FIELD_MARK, NULL_MARK
from mirrorwell.functions.names import SEQUENCE_ASSIGNMENT

# Columns of the data tables with their Spark types.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _columns(table: str) -> list[tuple[str, str]]:
    return [tuple(part.split(" ")) for part in COLUMNS[table].split(", ")]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _text(name: str, kind: str) -> str:
    if kind in ("double", "float"):
        text = f"CAST(CAST(round(CAST({name} AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)"
    elif kind == "timestamp_ntz":
        text = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
    elif kind == "string":
        text = f"(CAST(length({name}) AS VARCHAR) || ':' || {name})"
    elif kind.startswith("array"):
        text = f"array_to_string(list_transform({name}, lambda e: {_text('e', 'float')}), ',')"
    else:
        text = f"CAST({name} AS VARCHAR)"
    return f"COALESCE({text}, '{NULL_MARK}')"


def _row_hash(table: str, names: list[str] | None = None) -> str:
    fields = [_text(n, k) for n, k in _columns(table) if names is None or n in names]
    return f"CAST('0x' || substr(md5(concat_ws('{FIELD_MARK}', {', '.join(fields)})), 1, 15) AS BIGINT)"


def _content(table: str, relation: str, where: str = "TRUE") -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS n, "
        f"CAST(COALESCE(sum(CAST({_row_hash(table)} AS HUGEINT)), 0) AS VARCHAR) AS content "
        f"FROM {relation} WHERE {where}"
    )


_LOSSES = {"orders": "o_orderstatus <> 'P'", "documents": "lang <> 'en'", "events": "value < 90"}
_ALTERED = {
    "orders": "(SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 "
    "ELSE o_totalprice END AS o_totalprice) FROM orders)",
    "pages": "(SELECT * REPLACE (upper(url) AS url) FROM pages)",
    "labels": "(SELECT * REPLACE (nullif(toxic, 1) AS toxic) FROM labels)",
}

_COMPARE_ROWS = _union(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_source, "
    f"(SELECT count(*) FROM {t} WHERE {_LOSSES.get(t, 'TRUE')}) AS rows_target"
    for t in COLUMNS
)


def _compare_content(tables, where=lambda t: "TRUE") -> str:
    source = _union(_content(t, t, where(t)) for t in tables)
    target = _union(_content(t, _ALTERED.get(t, t), where(t)) for t in tables)
    return f"""
WITH s AS ({source}), t AS ({target})
SELECT table_name, s.n AS rows_source, s.content AS content_source,
       t.n AS rows_target, t.content AS content_target,
       s.n = t.n AND s.content = t.content AS match
FROM s JOIN t USING (table_name)"""


_SAMPLE_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}

_TENANTS = """
months AS (
  SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS month, bool_or(o_orderstatus = 'P') AS pending
  FROM orders GROUP BY 1, 2),
tables AS (
  SELECT 'C' || o_custkey AS owner, 'ORDERS_' || month AS table_name FROM months
  UNION ALL SELECT 'C' || o_custkey, 'LINES_' || month FROM months
  UNION ALL SELECT 'C' || c_custkey, 'CUSTOMER' FROM customer
  UNION ALL SELECT 'SHARED', 'NATION_' || n_nationkey FROM nation),
keys AS (
  SELECT 'C' || o_custkey AS owner, 'ORDERS_' || month AS table_name,
         'FK_ORDERS_CUSTOMER' AS constraint_name, 'C' || o_custkey AS parent_owner,
         'CUSTOMER' AS parent_table, CASE WHEN pending THEN 'DISABLED' ELSE 'ENABLED' END AS status
  FROM months
  UNION ALL
  SELECT 'C' || o_custkey, 'LINES_' || month, 'FK_LINES_ORDERS', 'C' || o_custkey,
         'ORDERS_' || month, CASE WHEN pending THEN 'DISABLED' ELSE 'ENABLED' END
  FROM months
  UNION ALL
  SELECT 'C' || c_custkey, 'CUSTOMER', 'FK_CUSTOMER_NATION', 'SHARED', 'NATION_' || c_nationkey, 'ENABLED'
  FROM customer),
edges AS (
  SELECT DISTINCT owner AS child_owner, table_name AS child_table, parent_owner, parent_table
  FROM keys WHERE owner = parent_owner)"""

_LEVELS = """
walk AS (
  SELECT owner, table_name, 0 AS level FROM {nodes}
  UNION ALL
  SELECT e.child_owner, e.child_table, w.level + 1
  FROM {edges} e JOIN walk w ON e.parent_owner = w.owner AND e.parent_table = w.table_name)
SELECT owner, table_name, max(level) AS level FROM walk GROUP BY 1, 2"""

_STATUS = (
    "CASE event_type WHEN 'signup' THEN 'PLANNED' WHEN 'click' THEN 'RUNNING' "
    "WHEN 'purchase' THEN 'DONE' WHEN 'error' THEN 'FAILED' END"
)
_JOB_EVENTS = f"""
ev AS (
  SELECT 'j_' || user_id AS job_id, 'T_' || regexp_extract(props, '[0-9]+') AS table_name,
         event_id AS seq, ts, CASE WHEN event_type = 'signup' THEN ts END AS created_at,
         CASE WHEN event_type IN ('signup', 'view') THEN props END AS snapshot_id,
         {_STATUS} AS status, CASE WHEN event_type = 'error' THEN props END AS error,
         CASE WHEN event_type IN ('click', 'view') THEN CAST(round(value * 100) AS BIGINT) END AS rows_source,
         CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) END AS rows_target
  FROM events),
last_status AS (
  SELECT * FROM (
    SELECT job_id, status, error, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) AS place
    FROM ev WHERE status IS NOT NULL) WHERE place = 1)"""

_PART_PROFILES = """
SELECT p_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) * 50000 AS BIGINT) AS rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS size_mb,
       any_value(p_type) = 'PROMO' AS wide, any_value(p_size) = 50 AS refused
FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey"""

_TRIGGERS = """
triggers AS (
  SELECT 'DOCS' AS owner, 'DOC_' || upper(source) AS table_name,
         concat_ws(' ', text, chr(10) || ':New.Doc_Id  := App.' || lang || '_seq.NEXTVAL;', text,
                   ':NEW.src$no=' || lang || '_src.nextval; :new.skipped := 1;') AS body
  FROM documents),
found AS (
  SELECT DISTINCT owner, table_name, upper(c) AS column_name, upper(s) AS sequence_name
  FROM (SELECT owner, table_name, unnest(regexp_extract_all(body, '{p}', 1)) AS c,
               unnest(regexp_extract_all(body, '{p}', 2)) AS s FROM triggers))""".replace(
    "{p}", SEQUENCE_ASSIGNMENT
)

_IDS = (
    ("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"),
    ("orders", "o_orderkey"), ("events", "event_id"), ("documents", "doc_id"),
    ("conversations", "conv_id"), ("conversations", "turn"),
)

_MISSING = {
    "orders": "o_orderstatus <> 'P'",
    "customer": "c_acctbal >= 0",
    "part": "p_size > 5",
    "documents": "lang = 'en'",
}
_FOREIGN_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
)


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return f"""
SELECT 'fk_{child}_{parent}' AS constraint_name, '{child}' AS child_table, '{parent}' AS parent_table,
       count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_values, count(*) = 0 AS valid
FROM {child} c WHERE {column} IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM {parent} p WHERE p.{key} = c.{column} AND {_MISSING.get(parent, 'TRUE')})"""


def _filled(extra: str = "") -> str:
    return _union(
        f"SELECT '{t}' AS table_name, {i} AS column_id, '{n}' AS column_name, "
        f"'{k}' AS data_type, count({n}) AS filled{extra} FROM {t}"
        for t in COLUMNS
        for i, (n, k) in enumerate(_columns(t), 1)
    )


def _commit(seen_customer: str, seen_part: str, good: str = "ok") -> str:
    orders = "SELECT count(*) FROM orders"
    return f"""
SELECT 'CUSTOMER' AS table_name, '{good}' AS status, (SELECT count(*) FROM customer) AS rows_source,
       (SELECT count(*) FROM customer) AS rows_target, ({seen_customer}) AS rows_seen
UNION ALL
SELECT 'ORDERS', 'failed', ({orders}), ({orders} WHERE o_orderstatus <> 'O'),
       ({orders} WHERE o_orderstatus = 'F')
UNION ALL
SELECT 'PART', '{good}', (SELECT count(*) FROM part), (SELECT count(*) FROM part), ({seen_part})"""


def _plan_row(ordinal: int, table: str, level: int, requested: bool = False) -> str:
    return (
        f"SELECT {ordinal} AS ordinal, '{table.upper()}' AS table_name, {level} AS level, "
        f"{requested} AS requested, 'planned' AS status, (SELECT count(*) FROM {table}) AS rows"
    )


def _same_rows(tables) -> str:
    return _union(
        f"SELECT '{t.upper()}' AS table_name, count(*) AS rows_source, count(*) AS rows_target, "
        f"TRUE AS match FROM {t}"
        for t in tables
    )


ORACLES = {
    "copy_direct": "SELECT * FROM orders",
    "copy_parallel": "SELECT * FROM lineitem",
    "copy_chunked": "SELECT * FROM documents",
    "copy_chunked_by_key": "SELECT * FROM conversations",
    "copy_ranged": "SELECT * FROM events",
    "merge_chunks": "SELECT * FROM events",
    "copy_recreate": "SELECT * FROM customer",
    "copy_partitioned": "SELECT *, 'o_orderstatus' AS laid_out_by FROM orders",
    "copy_partition_overwrite": "SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN 'REVISED' "
    "ELSE o_orderpriority END AS o_orderpriority) FROM orders",
    "create_like": _filled(", CAST(0 AS BIGINT) AS filled_clone"),
    "snapshot_read": "SELECT * FROM orders WHERE o_orderstatus <> 'P'",
    "snapshot_pin": _union(
        f"SELECT '{t.upper()}' AS table_name, count(*) AS rows FROM {t}" for t in COLUMNS
    ),
    "table_profile": _union(
        f"SELECT '{t}' AS table_name, count(*) AS rows, FALSE AS partitioned, "
        f"{t == 'embeddings'} AS wide, FALSE AS refused FROM {t}"
        for t in COLUMNS
    ) + "\nUNION ALL\nSELECT 'orders_by_status', count(*), TRUE, FALSE, FALSE FROM orders",
    "column_catalog": _filled(),
    "chunk_counts": f"SELECT CAST({_row_hash('lineitem', ['l_orderkey', 'l_linenumber'])} % 8 AS INT) "
    "AS chunk, count(*) AS rows FROM lineitem GROUP BY 1",
    "chunk_totals": "SELECT CAST(4 AS BIGINT) AS chunks, count(*) AS rows, "
    "CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders",
    "chunk_ranges": """
WITH ends AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders),
w AS (SELECT low, CAST(ceil((high - low + 1) / 8.0) AS BIGINT) AS width FROM ends),
b AS (SELECT CAST(i AS INT) AS chunk, low + i * width AS lower, low + (i + 1) * width AS upper
      FROM w, range(8) r(i))
SELECT chunk, lower, upper,
       (SELECT count(*) FROM orders WHERE o_orderkey >= lower AND o_orderkey < upper) AS rows FROM b""",
    "chunk_depths": "SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, "
    "CAST(0 AS BIGINT) AS crowded, CAST(0 AS BIGINT) AS overlapping, TRUE AS as_many FROM orders",
    "project_drift": "SELECT c_name, CAST(c_custkey AS DECIMAL(20,0)) AS c_custkey, 'none' AS grade, "
    "c_acctbal, CAST(NULL AS INTEGER) AS checked FROM customer",
    "fk_edges": f"WITH {_TENANTS} SELECT * FROM edges",
    "fk_edges_shared": f"WITH {_TENANTS} SELECT parent_owner, parent_table, "
    "count(DISTINCT (owner, table_name)) AS children FROM keys WHERE owner <> parent_owner GROUP BY 1, 2",
    "fk_closure": f"""
WITH RECURSIVE {_TENANTS},
walk AS (
  SELECT owner, table_name, 0 AS depth FROM keys WHERE status = 'DISABLED' AND table_name LIKE 'LINES%'
  UNION
  SELECT e.parent_owner, e.parent_table, w.depth + 1
  FROM edges e JOIN walk w ON e.child_owner = w.owner AND e.child_table = w.table_name)
SELECT owner, table_name, min(depth) AS depth FROM walk GROUP BY 1, 2""",
    "load_order": f"WITH RECURSIVE {_TENANTS}, {_LEVELS.format(nodes='tables', edges='edges')}",
    "truncate_order": f"WITH RECURSIVE {_TENANTS}, {_LEVELS.format(nodes='tables', edges='edges')}",
    "fk_cycles": f"""
WITH RECURSIVE {_TENANTS},
all_edges AS (
  SELECT * FROM edges
  UNION
  SELECT 'C' || o_custkey, 'CUSTOMER', 'C' || o_custkey, 'ORDERS_' || max(month)
  FROM months JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0 GROUP BY o_custkey),
reach AS (
  SELECT child_owner AS owner, child_table AS a, parent_table AS b FROM all_edges
  UNION
  SELECT r.owner, r.a, e.parent_table FROM reach r
  JOIN all_edges e ON e.child_owner = r.owner AND e.child_table = r.b),
on_cycle AS (SELECT owner, a AS table_name FROM reach WHERE a = b)
SELECT DISTINCT r.owner, r.a AS table_name,
       EXISTS (SELECT 1 FROM on_cycle o WHERE o.owner = r.owner AND o.table_name = r.a) AS on_cycle
FROM reach r JOIN on_cycle c ON c.owner = r.owner AND c.table_name = r.b""",
    "fk_listing": f"WITH {_TENANTS} SELECT owner, table_name, constraint_name, status FROM keys "
    "WHERE table_name LIKE 'ORDERS%'",
    "select_tables": f"""
WITH {_TENANTS}
SELECT owner, table_name FROM tables WHERE table_name LIKE 'ORDERS_1997%' AND table_name IN (
  SELECT 'ORDERS_' || strftime(o_orderdate, '%Y%m') FROM orders WHERE o_totalprice > 450000)""",
    "plan_presence": """
SELECT 'C' || c_custkey AS owner, 'ORDERS_199801' AS table_name,
       CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                         AND strftime(o_orderdate, '%Y%m') = '199801')
            THEN 'planned' ELSE 'skipped' END AS status
FROM customer""",
    "verify_rows": f"SELECT *, rows_source = rows_target AS match FROM ({_COMPARE_ROWS})",
    "verify_hash": _compare_content(COLUMNS),
    "verify_hash_fast": "SELECT table_name, rows_source, rows_target, match FROM "
    f"({_compare_content(COLUMNS)})",
    "verify_sample": _compare_content(
        _SAMPLE_KEYS, lambda t: f"{_row_hash(t, _SAMPLE_KEYS[t])} % 10 = 0"
    ),
    "verify_diff": """
WITH target AS (
  SELECT * FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_quantity < 10)
  UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1),
lost AS (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM target),
extra AS (SELECT * FROM target EXCEPT ALL SELECT * FROM lineitem)
SELECT *, 'source' AS side, count(*) AS copies FROM lost GROUP BY ALL
UNION ALL
SELECT *, 'target' AS side, count(*) AS copies FROM extra GROUP BY ALL""",
    "fk_orphans": _union(_orphans(*fk) for fk in _FOREIGN_KEYS),
    "fk_cross_schema": _union(
        f"""
SELECT 'FK_{child.upper()}_{parent.upper()}' AS constraint_name, '{child.upper()}' AS child_table,
       'COMMON.{parent.upper()}' AS parent_table, count(*) AS orphan_rows,
       count(DISTINCT {column}) AS orphan_values, count(*) = 0 AS valid
FROM {child} WHERE {column} IS NOT NULL
AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {kept})"""
        for child, column, parent, key, kept in (
            ("orders", "o_custkey", "customer", "c_custkey", "c_acctbal >= 0"),
            ("events", "user_id", "customer", "c_custkey", "c_acctbal >= 0"),
            ("supplier", "s_nationkey", "nation", "n_nationkey", "TRUE"),
        )
    ),
    "run_outcome": f"""
WITH r AS ({_COMPARE_ROWS})
SELECT count(*) AS tables,
       string_agg(table_name, ',' ORDER BY table_name) FILTER (WHERE rows_source <> rows_target) AS failed_tables,
       bool_or(rows_source <> rows_target) AS any_failed,
       bool_and(rows_source = rows_target) AS all_match
FROM r""",
    "result_states": f"""
SELECT table_name, CASE WHEN rows_source <> rows_target THEN 'FAILED' WHEN rows_source < 100 THEN 'SKIPPED'
       WHEN table_name > 'p' THEN 'CANCELLED' ELSE 'DONE' END AS state
FROM ({_COMPARE_ROWS})""",
    "schema_remap": f"""
WITH {_TENANTS}
SELECT owner || '.' || table_name AS name,
       CASE WHEN owner = 'SHARED' THEN 'COMMON' ELSE owner END || '.' || table_name AS mapped
FROM tables""",
    "table_list_split": f"WITH {_TENANTS} SELECT o_custkey, 'ORDERS_' || month AS table_name FROM months",
    "trigger_sequences": f"WITH {_TRIGGERS} SELECT * FROM found",
    "id_columns": f"WITH {_TENANTS}, {_TRIGGERS} SELECT owner, table_name, 'ID' AS column_name, "
    "table_name || '_SEQ' AS sequence_name FROM tables UNION SELECT * FROM found",
    "id_high_water": _union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{c.upper()}_SEQ' AS sequence_name, "
            f"COALESCE(max({c}), 0) + 1 AS next_value FROM {t}"
            for t, c in _IDS
        ]
        + [
            "SELECT 'no_pages', 'page_id', 'PAGE_ID_SEQ', COALESCE(max(page_id), 0) + 1 "
            "FROM pages WHERE length(html) < 0"
        ]
    ),
    "strategy_choice": f"""
WITH p AS ({_PART_PROFILES})
SELECT p_partkey, rows,
       CASE WHEN refused THEN 'refused' WHEN wide THEN 'parallel_dml'
            WHEN size_mb < 250 AND rows < 1000000 THEN 'direct_copy'
            WHEN size_mb < 2048 AND rows < 50000000 THEN 'parallel_dml'
            ELSE 'chunked_staging' END AS strategy,
       CAST(least(6, greatest(1, ceil(size_mb / 256))) AS INTEGER) AS chunks
FROM p""",
    "strategy_without_chunks": f"""
WITH p AS ({_PART_PROFILES})
SELECT CASE WHEN refused THEN 'refused' WHEN wide THEN 'parallel_dml'
            WHEN size_mb < 250 AND rows < 1000000 THEN 'direct_copy'
            ELSE 'parallel_dml' END AS strategy, count(*) AS tables
FROM p GROUP BY 1""",
    "ledger_latest": f"""
WITH {_JOB_EVENTS},
facts AS (
  SELECT job_id, arg_max(snapshot_id, seq) FILTER (WHERE snapshot_id IS NOT NULL) AS snapshot_id,
         min(ts) FILTER (WHERE status = 'RUNNING') AS started_at,
         max(ts) FILTER (WHERE status IN ('DONE', 'FAILED', 'CANCELLED')) AS ended_at
  FROM ev GROUP BY job_id)
SELECT f.*, l.status, l.error FROM facts f LEFT JOIN last_status l USING (job_id)""",
    "ledger_tables": f"""
WITH {_JOB_EVENTS}
SELECT job_id, table_name,
       arg_max(rows_source, seq) FILTER (WHERE rows_source IS NOT NULL) AS rows_source,
       arg_max(rows_target, seq) FILTER (WHERE rows_target IS NOT NULL) AS rows_target,
       arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
       arg_max(error, seq) FILTER (WHERE error IS NOT NULL) AS error,
       min(ts) FILTER (WHERE status = 'RUNNING') AS started_at,
       max(ts) FILTER (WHERE status IN ('DONE', 'FAILED')) AS ended_at
FROM ev GROUP BY job_id, table_name""",
    "ledger_top_jobs": f"""
WITH {_JOB_EVENTS},
jobs AS (SELECT job_id, arg_max(created_at, seq) FILTER (WHERE created_at IS NOT NULL) AS created_at
         FROM ev GROUP BY job_id)
SELECT j.job_id, j.created_at, l.status FROM jobs j LEFT JOIN last_status l USING (job_id)
WHERE created_at IS NOT NULL ORDER BY created_at DESC, job_id DESC LIMIT 20""",
    "ledger_config": """
SELECT 'j_' || user_id AS job_id, event_id AS seq, upper(event_type) AS source_schema,
       CASE WHEN value > 50 THEN 'per_table' ELSE 'defer_insert_commits' END AS commit_mode,
       'ORDERS,T_' || user_id AS tables
FROM events""",
    "ledger_drop": f"""
WITH {_JOB_EVENTS}
SELECT job_id, table_name, seq, status FROM ev
WHERE job_id NOT IN (SELECT job_id FROM last_status WHERE status = 'FAILED')""",
    "ledger_compacted": f"""
WITH {_JOB_EVENTS}
SELECT job_id, table_name,
       arg_max(rows_source, seq) FILTER (WHERE rows_source IS NOT NULL) AS rows_source,
       arg_max(rows_target, seq) FILTER (WHERE rows_target IS NOT NULL) AS rows_target,
       arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
       arg_max(error, seq) FILTER (WHERE error IS NOT NULL) AS error,
       min(ts) FILTER (WHERE status = 'RUNNING') AS started_at,
       max(ts) FILTER (WHERE status IN ('DONE', 'FAILED')) AS ended_at
FROM ev WHERE job_id NOT IN (SELECT job_id FROM last_status WHERE status = 'FAILED')
GROUP BY job_id, table_name""",
    "commit_per_table": _commit("SELECT count(*) FROM customer", "SELECT count(*) FROM part"),
    "commit_deferred": _commit(
        "SELECT count(*) FROM customer WHERE c_acctbal < 0",
        "SELECT count(*) FROM part WHERE p_size = 1",
        "rolled back",
    ),
    "refresh_orders": _union(
        f"SELECT '{t.upper()}' AS table_name, {level} AS level, count(*) AS rows_source, "
        f"count(*) AS rows_target, TRUE AS match, CAST(0 AS BIGINT) AS orphans, 'ok' AS status FROM {t}"
        for level, t in enumerate(["region", "nation", "customer", "orders"])
    ),
    "refresh_plan": _union(
        [
            _plan_row(0, "part", 0),
            _plan_row(1, "region", 0),
            "SELECT 2, 'RETURNS', 0, TRUE, 'skipped', NULL",
            _plan_row(3, "nation", 1),
            _plan_row(4, "customer", 2),
            _plan_row(5, "supplier", 2),
            _plan_row(6, "orders", 3),
            _plan_row(7, "lineitem", 4, True),
        ]
    ),
    "refresh_verify": _same_rows(
        ["lineitem", "orders", "part", "supplier", "customer", "nation", "region", "documents", "embeddings"]
    )
    + "\nUNION ALL SELECT 'RETURNS', NULL, NULL, NULL",
    "refresh_resume": _union(
        f"SELECT '{t.upper()}' AS table_name, 'ok' AS status, count(*) AS rows_target, TRUE AS published, "
        f"'{first}' AS first_status FROM {t}"
        for t, first in (
            ("region", "DONE"), ("nation", "DONE"), ("customer", "DONE"),
            ("events", "CANCELLED"), ("orders", "CANCELLED"),
        )
    ),
}
