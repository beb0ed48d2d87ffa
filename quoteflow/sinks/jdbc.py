"""Upsert into a relational table from a stream: staged rows are merged by primary key.

Each task writes its own rows over its own connection with one parameterised statement, so nothing
passes through the driver. The connection comes from the caller (any DB-API driver).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, types as T

# Column types of the relational table.
_SQL_TYPES = {
    T.StringType: "TEXT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.DoubleType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN",
    T.TimestampType: "TIMESTAMP",
    T.DateType: "DATE",
}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return _SQL_TYPES[type(kind)]


def create_statement(table: str, schema: T.StructType, keys: list[str]) -> str:
    columns = [
        f"{f.name} {sql_type(f.dataType)}{' NOT NULL' if f.name in keys else ''}" for f in schema.fields
    ]
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, PRIMARY KEY ({', '.join(keys)}))"


def evolve_statements(table: str, existing: list[str], schema: T.StructType) -> list[str]:
    """Add the columns the table does not have yet; added columns are nullable."""
    return [
        f"ALTER TABLE {table} ADD COLUMN {f.name} {sql_type(f.dataType)}"
        for f in schema.fields
        if f.name not in existing
    ]


def upsert_statement(table: str, columns: list[str], keys: list[str], mark: str = "%s") -> str:
    others = [c for c in columns if c not in keys]
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in others)
    action = f"DO UPDATE SET {sets}" if others else "DO NOTHING"
    values = ", ".join([mark] * len(columns))
    return (
        f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({values}) "
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def write(
    rows: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: list[str],
    mark: str = "%s",
    batch_rows: int = 1000,
    connections: int = 8,
) -> None:
    """Upsert ``rows``. A retried task repeats its upserts, which leaves the same table."""
    columns = rows.columns
    statement = upsert_statement(table, columns, keys, mark)

    def write_partition(part: Iterator) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            while chunk := [tuple(row) for row in islice(part, batch_rows)]:
                cursor.executemany(statement, chunk)
            connection.commit()
        finally:
            connection.close()

    # The database, not the cluster, bounds how many connections are wise. Rows are repartitioned, so
    # that the work before this point keeps its own parallelism.
    rows.repartition(connections).foreachPartition(write_partition)


class RelationalTable:
    """A relational table as the sink of a stream: created and grown by the sink itself.

    Takes the place of a ``KeyedTable`` in ``streaming.queries.region_stats``. A repeated batch repeats
    its upserts, which changes nothing.
    """

    def __init__(
        self,
        connect: Callable[[], object],
        table: str,
        schema: T.StructType,
        keys: list[str],
        mark: str = "%s",
        connections: int = 8,
    ):
        self.connect, self.table, self.schema, self.keys = connect, table, schema, keys
        self.mark, self.connections = mark, connections

    def create(self) -> RelationalTable:
        """Create the table, and add the columns that an older one lacks."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(create_statement(self.table, self.schema, self.keys))
            cursor.execute(f"SELECT * FROM {self.table} WHERE 1 = 0")
            existing = [column[0] for column in cursor.description]
            for statement in evolve_statements(self.table, existing, self.schema):
                cursor.execute(statement)
            connection.commit()
        finally:
            connection.close()
        return self

    def upsert(self, rows: DataFrame, batch: int, writer: str = "main") -> None:
        columns = self.schema.fieldNames()
        write(rows.select(*columns), self.connect, self.table, self.keys, self.mark, connections=self.connections)
