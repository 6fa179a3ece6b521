"""Schemas of every table the package reads, writes or returns."""

from pyspark.sql import types as T

from metaloom import fixed_values as fv


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


SOURCE_IDS = (fv.CATALOG_ID, fv.SCHEMA_ID, fv.TABLE_ID)
SOURCE_NAMES = (fv.CATALOG_NAME, fv.SCHEMA_NAME, fv.TABLE_NAME)

#: One row per listed table.
INVENTORY = T.StructType(_strings(*SOURCE_IDS, *SOURCE_NAMES, fv.TABLE_LOCATION, fv.TABLE_TYPE))

#: The metadata table.
METADATA = T.StructType(
    [T.StructField(fv.RECORD_ID, T.LongType())]
    + _strings(
        fv.CATALOG_ID,
        fv.CATALOG_NAME,
        fv.SCHEMA_ID,
        fv.SCHEMA_NAME,
        fv.TABLE_ID,
        fv.TABLE_NAME,
        fv.TABLE_LOCATION,
        fv.TABLE_TYPE,
        fv.INTEGRATION,
        fv.ACCOUNT,
    )
    + [T.StructField(fv.SYNC_DATE, T.TimestampType())]
    + _strings(fv.SYNC_STATUS, fv.SYNC_MESSAGE)
)

#: Columns a refresh overwrites on a known record.
REFRESHED = (*SOURCE_NAMES, fv.TABLE_LOCATION, fv.TABLE_TYPE, fv.INTEGRATION)

#: Columns only a status update writes.
SYNC = (fv.ACCOUNT, fv.SYNC_DATE, fv.SYNC_STATUS, fv.SYNC_MESSAGE)

#: Long tag table: one row per table and tag.
TAG_KEYS = ("catalog_name", "schema_name", "table_name")
TAGS = T.StructType(_strings(*TAG_KEYS, "tag_name", "tag_value"))

#: The discovery tags, which are also view columns.
TAG_NAMES = (
    fv.TARGET_DATABASE,
    fv.TARGET_SCHEMA,
    fv.TARGET_TABLE,
    fv.SYNC_FLAG,
    fv.EXTERNAL_VOLUME,
)

#: The enriched view.
VIEW = T.StructType(METADATA.fields + _strings(*TAG_NAMES, fv.LINK))

#: Result of running one table statement.
OUTCOMES = T.StructType(
    [T.StructField(fv.RECORD_ID, T.LongType())]
    + _strings("object_name", "error", "error_kind")
    + [T.StructField("applied_at", T.TimestampType())]
)

#: Status rows to merge into the metadata table.
STATUS = T.StructType(
    [
        T.StructField(fv.RECORD_ID, T.LongType()),
        *_strings(fv.ACCOUNT, fv.SYNC_STATUS, fv.SYNC_MESSAGE),
        T.StructField(fv.SYNC_DATE, T.TimestampType()),
    ]
)

#: Landed listing pages and the documents in their bodies.
SCHEMA_PAGES = T.StructType(_strings("catalog_name", "body"))
TABLE_PAGES = T.StructType(_strings("catalog_name", "schema_name", "body"))
SCHEMA_DOCUMENT = T.StructType(
    [
        T.StructField("namespaces", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("next-page-token", T.StringType()),
    ]
)
TABLE_DOCUMENT = T.StructType(
    [
        T.StructField(
            "identifiers",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("namespace", T.ArrayType(T.StringType())),
                        T.StructField("name", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("next-page-token", T.StringType()),
    ]
)

#: Entity tables.
CATALOG_ENTITIES = T.StructType(_strings("catalog_name", "storage_location"))
SCHEMA_ENTITIES = T.StructType(_strings("catalog_name", "schema_name", "schema_id"))
TABLE_ENTITIES = T.StructType(
    _strings(*TAG_KEYS, "table_id", "storage_location", "table_type")
)

#: Nested hierarchy: catalog > schemas > tables.
TABLE_NODE = T.StructType(_strings("uc_id", "uc_name", "sf_name", "location", "table_type"))
SCHEMA_NODE = T.StructType(
    [*_strings("uc_id", "uc_name", "sf_name"), T.StructField("tables", T.ArrayType(TABLE_NODE))]
)
CATALOG_NODE = T.StructType(
    [
        *_strings("uc_id", "uc_name", "sf_name"),
        T.StructField("page", T.LongType()),
        T.StructField("schemas", T.ArrayType(SCHEMA_NODE)),
    ]
)
