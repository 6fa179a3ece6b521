"""Statement texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from metaloom import fixed_values as fv
from metaloom.functions.text import dotted_name, fill, identifier, literal_text

#: Stands for the secret in a statement: rows and files never hold the secret itself.
SECRET_PLACEHOLDER = "${OAUTH_CLIENT_SECRET}"


def boolean_text(flag: Column) -> Column:
    return F.when(flag, F.lit("TRUE")).otherwise(F.lit("FALSE"))


def table_statement(auto_refresh: Column, quote_identifiers: bool = False) -> Column:
    """Creates one mirrored table. An absent or empty external volume leaves out its line."""
    volume = F.col(fv.EXTERNAL_VOLUME)
    return fill(
        fv.TABLE_STATEMENT,
        target=dotted_name(
            F.col(fv.TARGET_DATABASE),
            F.col(fv.TARGET_SCHEMA),
            F.col(fv.TARGET_TABLE),
            quoted=quote_identifiers,
        ),
        volume_line=F.when(volume != "", fill(fv.VOLUME_LINE, volume=literal_text(volume))).otherwise(
            F.lit("")
        ),
        integration=literal_text(F.col(fv.INTEGRATION)),
        table=literal_text(F.col(fv.TABLE_NAME)),
        auto_refresh=boolean_text(auto_refresh),
    )


def integration_statement(
    endpoint: Column,
    client_id: Column,
    interval: Column,
    mode: Column,
    quote_identifiers: bool = False,
) -> Column:
    """Creates the integration of one schema, with a placeholder for the secret."""
    return fill(
        fv.INTEGRATION_STATEMENT,
        integration=identifier(F.col(fv.INTEGRATION), quote_identifiers),
        schema=literal_text(F.col(fv.SCHEMA_NAME)),
        catalog=literal_text(F.col(fv.CATALOG_NAME)),
        catalog_uri=literal_text(F.concat(endpoint, F.lit(fv.CATALOG_PATH))),
        token_uri=literal_text(F.concat(endpoint, F.lit(fv.TOKEN_PATH))),
        mode=mode,
        client_id=literal_text(client_id),
        client_secret=F.lit(SECRET_PLACEHOLDER),
        interval=interval.cast("string"),
    )


def database_statement(quote_identifiers: bool = False) -> Column:
    return fill(
        fv.DATABASE_STATEMENT, database=identifier(F.col(fv.TARGET_DATABASE), quote_identifiers)
    )


def schema_statement(quote_identifiers: bool = False) -> Column:
    return fill(
        fv.SCHEMA_STATEMENT,
        database=identifier(F.col(fv.TARGET_DATABASE), quote_identifiers),
        schema=identifier(F.col(fv.TARGET_SCHEMA), quote_identifiers),
    )
