"""The registered queries in plain SQL over the given tables.

Written from the semantics, without looking at the plans, so that the two check each other.
"""

from __future__ import annotations

from metaloom import fixed_values as fv
from metaloom.plans.queries import CLIENT_ID, ENDPOINT

DB, SC, TB, FLAG, VOL = (
    fv.TARGET_DATABASE,
    fv.TARGET_SCHEMA,
    fv.TARGET_TABLE,
    fv.SYNC_FLAG,
    fv.EXTERNAL_VOLUME,
)

INVENTORY = f"""
inventory AS MATERIALIZED (
  SELECT CAST(n_nationkey AS VARCHAR) AS {fv.CATALOG_ID},
         CAST(c_custkey AS VARCHAR) AS {fv.SCHEMA_ID},
         CAST(o_orderkey AS VARCHAR) AS {fv.TABLE_ID},
         n_name AS {fv.CATALOG_NAME},
         c_name AS {fv.SCHEMA_NAME},
         'tbl_' || o_orderkey AS {fv.TABLE_NAME},
         's3://lake/' || n_name || '/' || c_name || '/' || o_orderkey AS {fv.TABLE_LOCATION},
         CASE WHEN o_orderstatus = 'F' THEN 'MANAGED' ELSE 'EXTERNAL' END AS {fv.TABLE_TYPE},
         o_orderkey, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

INVENTORY_COLUMNS = ", ".join(
    (
        fv.CATALOG_ID,
        fv.SCHEMA_ID,
        fv.TABLE_ID,
        fv.CATALOG_NAME,
        fv.SCHEMA_NAME,
        fv.TABLE_NAME,
        fv.TABLE_LOCATION,
        fv.TABLE_TYPE,
    )
)

ALL_SCHEMAS = """
all_schemas AS (
  SELECT n_name AS catalog_name, c_name AS schema_name, CAST(c_custkey AS VARCHAR) AS schema_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT n_name, s_name, 's' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

TAGS = f"""
tags AS MATERIALIZED (
  SELECT {fv.CATALOG_NAME} AS catalog_name, {fv.SCHEMA_NAME} AS schema_name,
         {fv.TABLE_NAME} AS table_name, d.tag_name,
         CASE d.tag_name WHEN '{DB}' THEN {fv.CATALOG_NAME} WHEN '{SC}' THEN {fv.SCHEMA_NAME}
                         WHEN '{TB}' THEN {fv.TABLE_NAME} WHEN '{VOL}' THEN '' ELSE 'true'
         END AS tag_value
  FROM inventory,
       (VALUES ('{DB}'), ('{SC}'), ('{TB}'), ('{VOL}'), ('{FLAG}')) AS d(tag_name)
  WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT {fv.CATALOG_NAME}, {fv.SCHEMA_NAME}, {fv.TABLE_NAME},
         CASE l_linenumber WHEN 1 THEN '{DB}' WHEN 2 THEN '{SC}' WHEN 3 THEN '{TB}'
                           WHEN 4 THEN '{FLAG}' WHEN 5 THEN '{VOL}' WHEN 6 THEN 'owner'
                           ELSE 'cost_center' END,
         CASE WHEN l_quantity = 50 THEN NULL
              WHEN l_linenumber = 1 THEN 'db_' || l_returnflag || l_linestatus
              WHEN l_linenumber = 2 THEN 'sc_' || l_suppkey
              WHEN l_linenumber = 3 THEN 'it''s_' || l_partkey
              WHEN l_linenumber = 4 THEN
                CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'true' WHEN 'AO' THEN 'TRUE'
                     WHEN 'NF' THEN 'yes' WHEN 'NO' THEN '1' WHEN 'RF' THEN 'maybe'
                     ELSE 'false' END
              WHEN l_linenumber = 5 THEN 'vol''' || l_suppkey
              ELSE CAST(l_partkey AS VARCHAR) END
  FROM lineitem JOIN inventory ON l_orderkey = o_orderkey
)"""

PIVOT = f"""
pivoted AS (
  SELECT catalog_name, schema_name, table_name,
         {", ".join(f"max(tag_value) FILTER (WHERE tag_name = '{t}') AS {t}" for t in (DB, SC, TB, FLAG, VOL))}
  FROM tags WHERE tag_name IN ('{DB}', '{SC}', '{TB}', '{FLAG}', '{VOL}')
  GROUP BY catalog_name, schema_name, table_name
)"""

OUTCOMES = f"""
outcomes AS (
  SELECT l_orderkey, 'tbl_' || l_orderkey AS object_name,
         CASE l_returnflag WHEN 'N' THEN 'object ' || l_partkey || ' already exists'
                           WHEN 'R' THEN 'no access to volume ' || l_suppkey END AS error,
         CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_linestatus = 'F' THEN 'compile'
              WHEN l_returnflag = 'N' THEN 'conflict' ELSE 'other' END AS error_kind,
         l_shipdate AS applied_at,
         CASE WHEN l_linestatus = 'F' THEN 'Org' || l_suppkey || '-Acct'
              WHEN l_quantity < 25 THEN 'ORG-Acct' || l_suppkey || '-X' ELSE 'nodash' END AS account,
         l_linenumber, l_partkey, l_suppkey
  FROM lineitem
),
status AS (
  SELECT l_orderkey, account AS {fv.ACCOUNT}, applied_at AS {fv.SYNC_DATE},
         CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS {fv.SYNC_STATUS},
         CASE WHEN error IS NULL THEN 'Table ''' || object_name || ''' created successfully.'
              WHEN error_kind = 'compile' THEN 'SQL compilation error: ' || error
              ELSE 'Error executing DDL: ' || error END AS {fv.SYNC_MESSAGE},
         l_linenumber, l_partkey, l_suppkey
  FROM outcomes
),
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {fv.SYNC_DATE} DESC,
                                 l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
    FROM status) WHERE rn = 1
)"""

SYNC_COLUMNS = f"{fv.ACCOUNT}, {fv.SYNC_DATE}, {fv.SYNC_STATUS}, {fv.SYNC_MESSAGE}"

METADATA = f"""
metadata AS (
  SELECT {INVENTORY_COLUMNS}, o_orderstatus, {SYNC_COLUMNS}
  FROM inventory LEFT JOIN newest ON o_orderkey = l_orderkey
)"""

VIEW = f"""
view_rows AS (
  SELECT {INVENTORY_COLUMNS}, {SYNC_COLUMNS}, {DB}, {SC}, {TB}, {FLAG}, {VOL},
         CASE WHEN {fv.SYNC_STATUS} = 'success' AND strpos({fv.ACCOUNT}, '-') > 0 THEN
           '{fv.LINK_HOST}' || lower(string_split({fv.ACCOUNT}, '-')[1]) || '/'
           || lower(string_split({fv.ACCOUNT}, '-')[2]) || '/#/data/databases/' || upper({DB})
           || '/schemas/' || upper({SC}) || '/table/' || upper({TB}) END AS {fv.LINK}
  FROM metadata LEFT JOIN pivoted
    ON {fv.CATALOG_NAME} = catalog_name AND {fv.SCHEMA_NAME} = schema_name
   AND {fv.TABLE_NAME} = table_name
)"""

UNSYNCED = f"""
unsynced AS (
  SELECT {INVENTORY_COLUMNS},
         '{fv.INTEGRATION_PREFIX}' || {fv.CATALOG_ID} || '_' || {fv.SCHEMA_ID} AS {fv.INTEGRATION},
         {DB}, {SC}, {TB}, {FLAG}, {VOL}
  FROM inventory LEFT JOIN pivoted
    ON {fv.CATALOG_NAME} = catalog_name AND {fv.SCHEMA_NAME} = schema_name
   AND {fv.TABLE_NAME} = table_name
),
untagged AS (
  SELECT * FROM unsynced
  WHERE {DB} IS NULL AND {SC} IS NULL AND {TB} IS NULL AND {FLAG} IS NULL
),
eligible AS (
  SELECT DISTINCT {fv.INTEGRATION}, {fv.TABLE_NAME}, {DB}, {SC}, {TB}, {VOL}
  FROM unsynced
  WHERE lower(trim({FLAG})) IN ('t', 'true', 'y', 'yes', '1')
    AND {DB} IS NOT NULL AND {SC} IS NOT NULL AND {TB} IS NOT NULL
),
targets AS (
  SELECT DISTINCT {fv.INTEGRATION}, {fv.CATALOG_NAME}, {fv.SCHEMA_NAME} FROM unsynced
),
new_tags AS MATERIALIZED (
  SELECT {fv.CATALOG_NAME} AS catalog_name, {fv.SCHEMA_NAME} AS schema_name,
         {fv.TABLE_NAME} AS table_name, d.tag_name,
         CASE d.tag_name WHEN '{DB}' THEN {fv.CATALOG_NAME} WHEN '{SC}' THEN {fv.SCHEMA_NAME}
                         WHEN '{TB}' THEN {fv.TABLE_NAME} WHEN '{VOL}' THEN '' ELSE 'true'
         END AS tag_value
  FROM untagged,
       (VALUES ('{DB}'), ('{SC}'), ('{TB}'), ('{VOL}'), ('{FLAG}')) AS d(tag_name)
)"""

LANDED = """
locations AS (
  SELECT n_name AS catalog_name, n_regionkey, md5(n_name) AS h FROM nation
),
catalog_ids AS (
  SELECT catalog_name, n_regionkey,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
         || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS catalog_id
  FROM locations
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_TAGGED = (INVENTORY, TAGS, PIVOT)
_SYNCED = (INVENTORY, OUTCOMES, METADATA)
_VIEW = f"""{_with(INVENTORY, TAGS, PIVOT, OUTCOMES, METADATA, VIEW)}
SELECT {INVENTORY_COLUMNS}, {SYNC_COLUMNS}, {DB}, {SC}, {TB}, {FLAG}, {VOL}, {fv.LINK} FROM view_rows"""
_METADATA = f"{_with(*_SYNCED)} SELECT {INVENTORY_COLUMNS}, {SYNC_COLUMNS} FROM metadata"
_UNSYNCED = _with(*_TAGGED, UNSYNCED)

_UPSERT = f"""{_with(*_SYNCED)},
known AS (SELECT * FROM metadata WHERE o_orderstatus <> 'P'),
batch AS (SELECT * FROM inventory WHERE o_orderstatus <> 'F')
SELECT coalesce(k.{fv.CATALOG_ID}, b.{fv.CATALOG_ID}) AS {fv.CATALOG_ID},
       coalesce(k.{fv.SCHEMA_ID}, b.{fv.SCHEMA_ID}) AS {fv.SCHEMA_ID},
       {fv.TABLE_ID},
       coalesce(b.{fv.CATALOG_NAME}, k.{fv.CATALOG_NAME}) AS {fv.CATALOG_NAME},
       coalesce(upper(b.{fv.SCHEMA_NAME}), k.{fv.SCHEMA_NAME}) AS {fv.SCHEMA_NAME},
       coalesce(b.{fv.TABLE_NAME} || '_new', k.{fv.TABLE_NAME}) AS {fv.TABLE_NAME},
       coalesce(b.{fv.TABLE_LOCATION} || '/new', k.{fv.TABLE_LOCATION}) AS {fv.TABLE_LOCATION},
       CASE WHEN b.o_orderkey IS NULL THEN k.{fv.TABLE_TYPE} ELSE 'FOREIGN' END AS {fv.TABLE_TYPE},
       {", ".join("k." + c for c in SYNC_COLUMNS.split(", "))}
FROM known k FULL JOIN batch b USING ({fv.TABLE_ID})"""

_SET_TAGS = """
SELECT * FROM new_tags
UNION ALL
SELECT t.* FROM tags t ANTI JOIN new_tags n USING (catalog_name, schema_name, table_name, tag_name)"""

_BROKEN = """
WITH RECURSIVE numbered AS (
  SELECT n_name AS catalog_name, c_custkey // 4 AS page FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2
),
chained AS (
  SELECT *, lag(page) OVER w AS before, lead(page) OVER w AS after FROM numbered
  WINDOW w AS (PARTITION BY catalog_name ORDER BY page)
),
pages AS MATERIALIZED (
  SELECT catalog_name, CASE WHEN before IS NOT NULL THEN CAST(page AS VARCHAR) END AS token,
         CAST(CASE WHEN page % 19 = 5 THEN coalesce(before, after) WHEN page % 29 = 11 THEN NULL ELSE after END AS VARCHAR) AS next
  FROM chained WHERE page % 17 <> 3
),
leads AS (
  SELECT catalog_name, token AS start, next FROM pages WHERE token IS NOT NULL AND next IS NOT NULL
  UNION
  SELECT l.catalog_name, l.start, p.next FROM leads l JOIN pages p ON p.catalog_name = l.catalog_name AND p.token = l.next
  WHERE p.next IS NOT NULL
)
SELECT DISTINCT catalog_name, 'listing: page ' || next || ' is missing' AS reason FROM pages p
WHERE next IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pages q WHERE q.catalog_name = p.catalog_name AND q.token = p.next)
UNION ALL
SELECT DISTINCT catalog_name, 'listing: the first page is missing' FROM pages p
WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.catalog_name = p.catalog_name AND q.token IS NULL)
UNION ALL
SELECT catalog_name, 'listing: no page leads to page ' || token FROM pages p
WHERE token IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pages q WHERE q.catalog_name = p.catalog_name AND q.next = p.token)
UNION ALL
SELECT catalog_name, 'listing: several pages lead to page ' || next FROM pages WHERE next IS NOT NULL
GROUP BY catalog_name, next HAVING count(*) > 1
UNION ALL
SELECT catalog_name, 'listing: page ' || start || ' leads back to itself' FROM leads WHERE start = next"""


def _table_statement(name: str, refresh: str) -> str:
    return f"""{_UNSYNCED}
SELECT {TB} AS object_name,
       'CREATE ICEBERG TABLE ' || {name} || ' IF NOT EXISTS' || chr(10)
       || CASE WHEN {VOL} <> '' THEN 'EXTERNAL_VOLUME = ''' || replace({VOL}, '''', '''''') || '''' || chr(10)
               ELSE '' END
       || 'CATALOG = ''' || {fv.INTEGRATION} || '''' || chr(10)
       || '    CATALOG_TABLE_NAME = ''' || {fv.TABLE_NAME} || '''' || chr(10)
       || '    AUTO_REFRESH = {refresh};' AS statement
FROM eligible"""


_INTEGRATION_LINES = [
    f"'CREATE CATALOG INTEGRATION ' || {fv.INTEGRATION}",
    "'CATALOG_SOURCE = ICEBERG_REST'",
    "'TABLE_FORMAT = ICEBERG'",
    f"'CATALOG_NAMESPACE = ''' || {fv.SCHEMA_NAME} || ''''",
    "'REST_CONFIG = ('",
    f"'    CATALOG_URI = ''{ENDPOINT}{fv.CATALOG_PATH}'','",
    f"'    WAREHOUSE = ''' || {fv.CATALOG_NAME} || ''','",
    "'    ACCESS_DELEGATION_MODE = VENDED_CREDENTIALS'",
    "')'",
    "'REST_AUTHENTICATION = ('",
    "'    TYPE = OAUTH,'",
    f"'    OAUTH_TOKEN_URI = ''{ENDPOINT}{fv.TOKEN_PATH}'','",
    f"'    OAUTH_CLIENT_ID = ''{CLIENT_ID}'','",
    "'    OAUTH_CLIENT_SECRET = ''${OAUTH_CLIENT_SECRET}'','",
    "'    OAUTH_ALLOWED_SCOPES = (''all-apis'', ''sql'')'",
    "')'",
    "'ENABLED = TRUE'",
    "'REFRESH_INTERVAL_SECONDS = 300;'",
]

ORACLE: dict[str, str] = {
    "tag_pivot": f"{_with(*_TAGGED)} SELECT * FROM pivoted",
    "enriched_view": _VIEW,
    "view_sql": _VIEW,
    "untagged_tables": f"""{_UNSYNCED}
SELECT {fv.CATALOG_NAME}, {fv.SCHEMA_NAME}, {fv.TABLE_NAME} FROM untagged""",
    "default_tags": f"{_UNSYNCED} SELECT * FROM new_tags",
    "tags_after_refresh": f"{_UNSYNCED}{_SET_TAGS}",
    "tags_of_untagged": f"""{_UNSYNCED}, after_set AS ({_SET_TAGS})
SELECT * FROM after_set SEMI JOIN new_tags USING (catalog_name, schema_name, table_name)""",
    "integration_targets": f"{_UNSYNCED} SELECT * FROM targets",
    "eligible_tables": f"{_UNSYNCED} SELECT * FROM eligible",
    "target_databases": f"{_UNSYNCED} SELECT DISTINCT {DB} FROM eligible",
    "target_schemas": f"{_UNSYNCED} SELECT DISTINCT {DB}, {SC} FROM eligible",
    "hierarchy_nest": f"""{_with(INVENTORY, ALL_SCHEMAS)}
SELECT catalog_name, schema_name, count(o_orderkey) AS n_tables,
       min({fv.TABLE_NAME}) AS first_table, max({fv.TABLE_NAME}) AS last_table
FROM all_schemas LEFT JOIN inventory
  ON catalog_name = {fv.CATALOG_NAME} AND schema_name = {fv.SCHEMA_NAME}
GROUP BY catalog_name, schema_name""",
    "hierarchy_flatten": f"{_with(INVENTORY)} SELECT {INVENTORY_COLUMNS} FROM inventory",
    "tables_per_schema": f"""{_with(INVENTORY, ALL_SCHEMAS)}
SELECT a.catalog_name AS {fv.CATALOG_NAME}, a.schema_name AS {fv.SCHEMA_NAME},
       count(o_orderkey) AS n_tables
FROM all_schemas a LEFT JOIN inventory i
  ON a.catalog_name = i.{fv.CATALOG_NAME} AND a.schema_name = i.{fv.SCHEMA_NAME}
GROUP BY 1, 2""",
    "inventory_from_pages": f"""{_with(INVENTORY, LANDED)}
SELECT catalog_id AS {fv.CATALOG_ID}, {INVENTORY_COLUMNS.split(", ", 1)[1]}
FROM inventory JOIN catalog_ids ON catalog_name = {fv.CATALOG_NAME}""",
    "listed_schemas": f"{_with(ALL_SCHEMAS)} SELECT catalog_name, schema_name FROM all_schemas",
    "included_schemas": f"""{_with(INVENTORY)}
SELECT i.{fv.CATALOG_NAME} AS catalog_name, i.{fv.SCHEMA_NAME} AS schema_name,
       i.{fv.TABLE_NAME} AS table_name
FROM inventory i JOIN customer ON c_name = i.{fv.SCHEMA_NAME} WHERE c_mktsegment = 'BUILDING'""",
    "entity_lookup_join": f"""{_with(INVENTORY, LANDED)}
SELECT {fv.CATALOG_NAME}, {fv.SCHEMA_NAME}, {fv.TABLE_NAME},
       CASE WHEN n_regionkey <> 0 THEN {fv.TABLE_ID} END AS {fv.TABLE_ID},
       CASE WHEN n_regionkey = 0 THEN 'catalog has no id' END AS reason
FROM inventory JOIN catalog_ids ON catalog_name = {fv.CATALOG_NAME}""",
    "rejected_pages": """
SELECT url AS catalog_name, 'web' AS schema_name, CAST(NULL AS VARCHAR) AS table_name,
       'page is no listing: ' || html AS reason FROM pages""",
    "catalog_uuid": """
WITH hashes AS (SELECT o_orderkey, o_orderstatus, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
SELECT o_orderkey,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
         || substr(h, 17, 4) || '-' || substr(h, 21, 12) END AS catalog_id
FROM hashes""",
    "record_keys": f"""{_with(INVENTORY)}
SELECT {fv.CATALOG_NAME}, count(*) AS n_tables, count(DISTINCT {fv.TABLE_ID}) AS n_records,
       count(DISTINCT {fv.SCHEMA_ID}) AS n_integrations, true AS non_negative
FROM inventory GROUP BY {fv.CATALOG_NAME}""",
    "upsert_metadata": _UPSERT,
    "upsert_small_batch": _UPSERT,
    "latest_status": f"""{_with(OUTCOMES)}
SELECT l_orderkey AS {fv.RECORD_ID}, {SYNC_COLUMNS} FROM newest""",
    "status_update": _METADATA,
    "status_batch": f"""{_with(INVENTORY)}
SELECT {INVENTORY_COLUMNS}, 'Org-' || {fv.SCHEMA_ID} AS {fv.ACCOUNT},
       TIMESTAMP '2024-01-02 03:04:05' AS {fv.SYNC_DATE}, 'success' AS {fv.SYNC_STATUS},
       'applied ' || {fv.TABLE_NAME} AS {fv.SYNC_MESSAGE}
FROM inventory WHERE o_orderstatus <> 'F'""",
    "table_outcomes": f"""{_with(OUTCOMES)}
SELECT l_orderkey AS {fv.RECORD_ID}, {SYNC_COLUMNS} FROM status""",
    "integration_outcomes": f"""{_with(OUTCOMES)}
SELECT object_name, error, error_kind,
       CASE WHEN error IS NULL THEN 'created'
            WHEN error_kind <> 'other' AND contains(error, 'already exists') THEN 'skipped'
            ELSE 'error' END AS result
FROM outcomes""",
    "container_outcomes": f"""{_with(OUTCOMES)}
SELECT object_name, error, error_kind,
       CASE WHEN error IS NULL THEN 'created' WHEN error_kind = 'conflict' THEN 'already exists'
            ELSE 'error' END AS result
FROM outcomes""",
    "table_statements": _table_statement(f"{DB} || '.' || {SC} || '.' || {TB}", "TRUE"),
    "table_statements_quoted": _table_statement(
        f"""'"' || {DB} || '"."' || {SC} || '"."' || {TB} || '"'""", "FALSE"
    ),
    "container_statements": f"""{_UNSYNCED}, named AS (
    SELECT DISTINCT CASE WHEN ascii(reverse({DB})) % 3 <> 0 THEN {DB} END AS db,
           CASE WHEN ascii(reverse({SC})) % 3 <> 0 THEN {SC} END AS sc
    FROM eligible
)
SELECT DISTINCT db AS object_name, 'CREATE DATABASE ' || db AS statement FROM named WHERE db IS NOT NULL
UNION ALL
SELECT db || '.' || sc, 'CREATE SCHEMA ' || db || '.' || sc FROM named WHERE db IS NOT NULL AND sc IS NOT NULL""",
    "integration_statements": f"""{_UNSYNCED}
SELECT {fv.INTEGRATION} AS object_name,
       {" || chr(10) || ".join(_INTEGRATION_LINES)} AS statement
FROM targets""",
    "metadata_roundtrip": _METADATA,
    "stored_view": _VIEW,
    "stored_upsert": _UPSERT,
    "view_from_buckets": _VIEW,
    "upsert_into_buckets": _UPSERT,
    "applied_statements": f"""
SELECT object_name, 'Org-Acct' AS {fv.ACCOUNT},
       CASE WHEN contains(statement, 'EXTERNAL_VOLUME') THEN 'compile' END AS error_kind,
       CASE WHEN contains(statement, 'EXTERNAL_VOLUME') THEN 'failed' ELSE 'success' END AS {fv.SYNC_STATUS},
       CASE WHEN contains(statement, 'EXTERNAL_VOLUME') THEN 'SQL compilation error: SQL compilation error: volume not found'
            ELSE 'Table ''' || object_name || ''' created successfully.' END AS {fv.SYNC_MESSAGE}
FROM ({_table_statement(f"{DB} || '.' || {SC} || '.' || {TB}", "TRUE")})""",
    "batch_stamp": "SELECT count(*) AS n_outcomes, least(count(*), 1) AS n_stamps, count(*) > 0 AS is_now FROM lineitem",
    "run_inputs": """
SELECT l_orderkey, l_linenumber, ' CREATE DATABASE db_' || l_partkey AS statement FROM lineitem WHERE l_linenumber > 3""",
    "broken_listings": _BROKEN,
    "combinations_list": f"{_UNSYNCED} SELECT * FROM targets",
}
