"""Values other systems already rely on: column names, tag names and text formats.

FIXED VALUES: everything in this file is an interface. Stored tables, tags set by
users and rendered statements carry these exact strings, so none of them may change.
"""

# Metadata table columns, in stored order.
RECORD_ID = "dbx_sf_uniform_metadata_id"
CATALOG_ID = "uc_catalog_id"
CATALOG_NAME = "uc_catalog_name"
SCHEMA_ID = "uc_schema_id"
SCHEMA_NAME = "uc_schema_name"
TABLE_ID = "uc_table_id"
TABLE_NAME = "uc_table_name"
TABLE_LOCATION = "table_location"
TABLE_TYPE = "table_type"
INTEGRATION = "snowflake_catalog_integration"
ACCOUNT = "snowflake_account_id"
SYNC_DATE = "sync_date"
SYNC_STATUS = "sync_status"
SYNC_MESSAGE = "sync_message"

# Discovery tag names; the view shows each of them as a column of the same name.
TARGET_DATABASE = "snowflake_database"
TARGET_SCHEMA = "snowflake_schema"
TARGET_TABLE = "snowflake_table"
SYNC_FLAG = "snowflake_uniform_sync"
EXTERNAL_VOLUME = "snowflake_external_volume"

# Computed view column.
LINK = "snowflake_link"

# Default name of the metadata table, and the suffix of its view.
METADATA_TABLE = "dbx_sf_uniform_metadata"
VIEW_SUFFIX = "_vw"

# Schemas a listing contains but a refresh skips.
SYSTEM_SCHEMAS = ("information_schema",)

# A catalog's id is the first match of this pattern in its storage location.
UUID_PATTERN = "([a-f0-9-]{36})"

# Integration names are this prefix and a hash.
INTEGRATION_PREFIX = "dbx_uc_catint_"

# Sync status values and the message of a successful apply.
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
SUCCESS_MESSAGE = "Table '{table}' created successfully."

# Prefixes of the message of a failed apply.
COMPILE_ERROR_PREFIX = "SQL compilation error: "
OTHER_ERROR_PREFIX = "Error executing DDL: "

# An integration whose error holds this text is there already.
ALREADY_EXISTS = "already exists"

# Defaults of the default tags that do not depend on the table.
DEFAULT_SYNC_FLAG = "true"
DEFAULT_EXTERNAL_VOLUME = ""

# Defaults of the integration statement.
REFRESH_INTERVAL_SECONDS = 3600
ACCESS_DELEGATION_MODE = "VENDED_CREDENTIALS"

# Link of a synced table.
LINK_HOST = "https://app.snowflake.com/"
LINK_TEXT = (
    LINK_HOST + "{account_0}/{account_1}/#/data/databases/{database}/schemas/{schema}/table/{table}"
)

# Statement that creates a mirrored table, and its optional line.
VOLUME_LINE = "EXTERNAL_VOLUME = '{volume}'\n"
TABLE_STATEMENT = (
    "CREATE ICEBERG TABLE {target} IF NOT EXISTS\n"
    "{volume_line}"
    "CATALOG = '{integration}'\n"
    "    CATALOG_TABLE_NAME = '{table}'\n"
    "    AUTO_REFRESH = {auto_refresh};"
)

# Services of the source catalog, below its endpoint.
CATALOG_PATH = "/api/2.1/unity-catalog/iceberg"
TOKEN_PATH = "/oidc/v1/token"

# Statement that creates a catalog integration.
INTEGRATION_STATEMENT = """\
CREATE CATALOG INTEGRATION {integration}
CATALOG_SOURCE = ICEBERG_REST
TABLE_FORMAT = ICEBERG
CATALOG_NAMESPACE = '{schema}'
REST_CONFIG = (
    CATALOG_URI = '{catalog_uri}',
    WAREHOUSE = '{catalog}',
    ACCESS_DELEGATION_MODE = {mode}
)
REST_AUTHENTICATION = (
    TYPE = OAUTH,
    OAUTH_TOKEN_URI = '{token_uri}',
    OAUTH_CLIENT_ID = '{client_id}',
    OAUTH_CLIENT_SECRET = '{client_secret}',
    OAUTH_ALLOWED_SCOPES = ('all-apis', 'sql')
)
ENABLED = TRUE
REFRESH_INTERVAL_SECONDS = {interval};"""

# Statements that create a target database or schema.
DATABASE_STATEMENT = "CREATE DATABASE {database}"
SCHEMA_STATEMENT = "CREATE SCHEMA {database}.{schema}"
