"""Metric tables in a relational database, written by the executors."""

import os
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """A target table: its columns with SQL types, and its primary key."""

    name: str
    columns: dict[str, str]
    primary_key: tuple[str, ...]

    def ddl(self) -> str:
        """The statement that creates the table with its primary key."""
        body = [f"{c} {t}" for c, t in self.columns.items()]
        body.append(f"PRIMARY KEY ({', '.join(self.primary_key)})")
        return f"CREATE TABLE {self.name} ({', '.join(body)})"

    def staged(self) -> "Table":
        """The table that is filled before it takes this one's name."""
        return replace(self, name=f"{self.name}_next")

    def prepare(self) -> list[str]:
        """Statements that leave an empty staging table with the key, and a target to swap it with."""
        staging = self.staged()
        ensure = self.ddl().replace("CREATE TABLE", "CREATE TABLE IF NOT EXISTS", 1)
        return [f"DROP TABLE IF EXISTS {staging.name}", staging.ddl(), ensure, f"DROP TABLE IF EXISTS {self.name}_old"]

    def swap(self, dialect: str) -> list[str]:
        """Statements that give the staging table the target's name, at once for every reader."""
        name, staging, old = self.name, self.staged().name, f"{self.name}_old"
        renames = {
            # One statement renames both; other sessions see the one or the other.
            "mysql": [f"RENAME TABLE {name} TO {old}, {staging} TO {name}"],
            "postgresql": [
                "BEGIN",
                f"ALTER TABLE {name} RENAME TO {old}",
                f"ALTER TABLE {staging} RENAME TO {name}",
                "COMMIT",
            ],
        }[dialect]
        return [*renames, f"DROP TABLE {old}"]

    def column_types(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns.items())


# Column names and types of the published metric tables.
FUNNEL_TABLE = Table(
    "metrics_funnel_daily",
    {
        "dt": "DATE",
        "sessions_total": "BIGINT",
        "sessions_event_list": "BIGINT",
        "sessions_event_detail": "BIGINT",
        "sessions_begin_checkout": "BIGINT",
        "sessions_purchase": "BIGINT",
        "conversion_rate": "DOUBLE",
    },
    ("dt",),
)
RANK_TABLE = Table(
    "metrics_event_rank",
    {
        "dt": "DATE",
        "event_id": "BIGINT",
        "detail_views": "BIGINT",
        "purchases": "BIGINT",
        "revenue_total": "DOUBLE",
        "interest_to_purchase_ratio": "DOUBLE",
    },
    ("dt", "event_id"),
)
ANOMALY_TABLE = Table(
    "metrics_anomalies",
    {
        "dt": "DATE",
        "ip": "VARCHAR(64)",
        "requests": "BIGINT",
        "errors": "BIGINT",
        "purchases": "BIGINT",
        "sessions": "BIGINT",
        "avg_latency_ms": "DOUBLE",
        "max_latency_ms": "DOUBLE",
        "is_anomaly": "BOOLEAN",
        "reason": "VARCHAR(255)",
    },
    ("dt", "ip"),
)


def to_sink_types(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles; the others as they are."""
    wide = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(wide) if wide else df


def sink_frame(df: DataFrame, table: Table) -> DataFrame:
    """``df`` cut to the table's columns and given its types."""
    rows = to_sink_types(df.select(*table.columns))
    days = {c: F.col(c).try_cast("date") for c, t in table.columns.items() if t == "DATE"}
    return rows.withColumns(days)


def unkeyed_rows(df: DataFrame, table: Table) -> DataFrame:
    """Rows that a primary key would refuse: a key column is null, or a day that is no date."""
    keys = reduce(or_, [F.col(k).isNull() for k in table.primary_key])
    return sink_frame(df, table).filter(keys)


def replace_table(
    df: DataFrame,
    url: str,
    table: Table,
    options: dict[str, str],
    execute: Callable[[list[str]], None],
    fill: Callable[[DataFrame, Table], None] | None = None,
    writers: int = 4,
) -> DataFrame:
    """Replace the table's rows by those of ``df``, key included, and return the rows left out.

    ``execute`` runs statements one after another on one connection of the caller's
    driver. A staging table is made with the primary key, filled by the executors and
    renamed into place: readers see the old rows or the new ones. A task that is
    repeated after its commit fails on the key and with it the job, before anything
    was renamed; no rows are doubled. Rows without a key, which the database would
    refuse, are left out and returned (:func:`unkeyed_rows`).
    """
    dialect = url.split(":")[1]
    swap = table.swap(dialect)
    keyed = sink_frame(df, table).dropna(subset=list(table.primary_key))

    def append(rows: DataFrame, target: Table) -> None:
        writer = rows.write.format("jdbc").mode("append")
        writer.options(url=url, dbtable=target.name, numPartitions=writers, **options).save()

    execute(table.prepare())
    (fill or append)(keyed, table.staged())
    execute(swap)
    return unkeyed_rows(df, table)


def connection_options(env: dict[str, str] = os.environ) -> dict[str, str]:
    """JDBC user and password from ``METRICS_DB_USER`` and ``METRICS_DB_PASSWORD``."""
    return {"user": env["METRICS_DB_USER"], "password": env["METRICS_DB_PASSWORD"]}


def write_jdbc(
    df: DataFrame, url: str, table: Table, options: dict[str, str], keep_definition: bool = False, writers: int = 4
) -> None:
    """Replace the table's rows by those of ``df``.

    Without ``keep_definition`` the table is dropped and created with the
    declared types. Spark's writer cannot declare a primary key, so a table
    that needs one is created once from ``table.ddl()`` and then refilled with
    ``keep_definition=True``; the key also turns a task that was repeated after
    its commit into an error instead of double rows. At most ``writers``
    connections are opened.
    """
    writer = (
        sink_frame(df, table)
        .write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=table.name, numPartitions=writers, **options)
    )
    if keep_definition:
        writer = writer.option("truncate", True)
    else:
        writer = writer.option("createTableColumnTypes", table.column_types())
    writer.save()
