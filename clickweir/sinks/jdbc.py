"""Relational result tables through Spark's JDBC writer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DEFAULT_BATCH_SIZE = 500


@dataclass(frozen=True)
class JdbcTarget:
    """Connection settings; credentials come from the caller's configuration."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = DEFAULT_BATCH_SIZE

    def writer_properties(self) -> dict[str, str]:
        return {"batchsize": str(self.batch_size), **self.properties}


def write_jdbc_overwrite(df: DataFrame, target: JdbcTarget, truncate: bool = True) -> None:
    """Replace the rows of a result table (keeping its definition by default)."""
    properties = target.writer_properties() | {"truncate": str(truncate).lower()}
    df.write.mode("overwrite").jdbc(target.url, target.table, properties=properties)


def upsert_statement(
    table: str, staging: str, columns: list[str], keys: list[str], dialect: str = "ansi"
) -> str:
    """One statement that inserts or updates ``table`` from ``staging`` by key."""
    values = [c for c in columns if c not in keys]
    names = ", ".join(columns)
    if dialect == "mysql":
        updates = ", ".join(f"{c} = VALUES({c})" for c in values or keys)
        return (
            f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
            f"ON DUPLICATE KEY UPDATE {updates}"
        )
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    matched = f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in values)} "
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on} {matched if values else ''}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def execute(spark: SparkSession, target: JdbcTarget, statement: str) -> None:
    """Run one statement in its own transaction, through the JVM's driver manager.

    Spark registers the driver class when it writes through the same settings.
    """
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in target.properties.items():
        settings.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(target.url, settings)
    try:
        connection.setAutoCommit(False)
        work = connection.createStatement()
        try:
            work.executeUpdate(statement)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            work.close()
    finally:
        connection.close()


def upsert_jdbc(
    df: DataFrame, target: JdbcTarget, keys: list[str], dialect: str = "ansi",
    staging: str | None = None,
) -> None:
    """Insert or update by key, all or nothing.

    Executors load a staging table in parallel; one statement then moves its rows,
    so readers see all of the result or none of it, and a retried task only
    repeats work on the staging table.
    """
    staging = staging or f"{target.table}_staging"
    df.write.mode("overwrite").jdbc(target.url, staging, properties=target.writer_properties())
    execute(
        df.sparkSession, target,
        upsert_statement(target.table, staging, df.columns, keys, dialect),
    )
