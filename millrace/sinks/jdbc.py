"""SQL destinations over JDBC. The driver jar comes with the session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# The schema a destination uses when the table name has none.
DEFAULT_SCHEMAS = {"sqlite": "main"}


def split_table(name: str, scheme: str = "") -> tuple[str, str]:
    """``schema.table``, split on the first dot."""
    schema, dot, table = name.partition(".")
    if dot and schema and table:
        return schema, table
    if scheme in DEFAULT_SCHEMAS and name and not dot:
        return DEFAULT_SCHEMAS[scheme], name
    raise ValueError(f"table must be given as schema.table, got {name!r}")


def write_jdbc(
    df: DataFrame, url: str, table: str, replace: bool = False, batch_size: int = 10_000, **properties: str
) -> None:
    """Rows into ``<table>__staging`` in parallel, then into the table in one transaction.

    A task that is repeated may send its rows twice, so the table itself is never written in
    parallel: staging is made anew by every attempt of the load and read after it has ended.
    """
    schema, name = split_table(table, url.split(":")[1] if url.startswith("jdbc:") else "")
    staging = f"{schema}.{name}__staging"
    df.write.jdbc(url, staging, "overwrite", writer_properties(batch_size, properties))
    run_statements(df.sparkSession, url, finish_statements(f"{schema}.{name}", staging, df.columns, replace), properties)


def finish_statements(table: str, staging: str, columns: Sequence[str], replace: bool) -> list[str]:
    """What moves the staged rows into the table."""
    names = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
    move = f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}"
    return [*([f"DELETE FROM {table}"] if replace else []), move]


def run_statements(spark: SparkSession, url: str, statements: Sequence[str], properties: Mapping[str, str]) -> None:
    """Run statements on the database in one transaction."""
    settings = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def writer_properties(batch_size: int, properties: Mapping[str, str]) -> dict[str, str]:
    return {"batchsize": str(batch_size), "isolationLevel": "READ_COMMITTED", **properties}
