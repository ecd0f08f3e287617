"""Loading a database in one step (K2, K3, K4 over JDBC).

Spark's JDBC writer commits per partition, so a load that dies half-way leaves
half a table.  Here every table is loaded into a side table first, by as many
connections as the writer is given; only when all are complete does one
transaction on one connection make them visible: it exchanges the names (full
refresh), or moves the rows over and records the batch (append).  A failed load
leaves the old tables as they are, and the next one starts by dropping its side
tables.  A batch that is recorded is not loaded again.

The statements of a database are in ``DIALECTS``; its data definition statements
must be transactional, as those of PostgreSQL and Derby are.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SIDE, OLD = "__load", "__old"
BATCHES = "load_batches"

#: Statements that rename a table, by the name in the JDBC URL.
DIALECTS = {"derby": "RENAME TABLE {a} TO {b}", "postgresql": "ALTER TABLE {a} RENAME TO {b}", "h2": "ALTER TABLE {a} RENAME TO {b}"}
_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


class Connection:
    """One JDBC connection of the driver, for the few statements of a switch."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str]):
        jvm = spark._jvm
        if options.get("driver"):
            jvm.java.lang.Class.forName(options["driver"])
        props = jvm.java.util.Properties()
        for k in ("user", "password"):
            if options.get(k) is not None:
                props.setProperty(k, options[k])
        self._c = jvm.java.sql.DriverManager.getConnection(options["url"], props)
        self._c.setAutoCommit(False)

    def run(self, sql: str) -> int:
        s = self._c.createStatement()
        try:
            return s.executeUpdate(sql)
        finally:
            s.close()

    def has(self, table: str) -> bool:
        found = self._c.getMetaData().getTables(None, None, "%", None)
        try:
            while found.next():
                if found.getString("TABLE_NAME").lower() == table.lower():
                    return True
            return False
        finally:
            found.close()

    def value(self, sql: str):
        s = self._c.createStatement()
        try:
            r = s.executeQuery(sql)
            return r.getObject(1) if r.next() else None
        finally:
            s.close()

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, kind, *_) -> None:
        try:
            self._c.rollback() if kind else self._c.commit()
        finally:
            self._c.close()


def _rename(options: Mapping[str, str], a: str, b: str) -> str:
    database = options["url"].split(":")[1]
    if database not in DIALECTS:
        raise ValueError(f"no statement to rename a table of {database}; add it to DIALECTS")
    return DIALECTS[database].format(a=a, b=b)


def _checked_names(*names: str) -> None:
    for n in names:
        if not _NAME.fullmatch(n):
            raise ValueError(f"{n!r} is no plain table name or batch id")


def _load(tables: Mapping[str, DataFrame], options: Mapping[str, str]) -> None:
    for name, df in tables.items():
        df.write.format("jdbc").options(**options).option("dbtable", name + SIDE).mode("overwrite").save()


def replace_tables(spark: SparkSession, tables: Mapping[str, DataFrame], options: Mapping[str, str]) -> None:
    """Full refresh: readers of the database see all old tables or all new ones."""
    _checked_names(*tables)
    for name in tables:
        _rename(options, name, name)  # an unknown database is refused before anything is loaded
    _load(tables, options)
    with Connection(spark, options) as c:
        for name in tables:
            if c.has(name + OLD):
                c.run(f"DROP TABLE {name + OLD}")
            if c.has(name):
                c.run(_rename(options, name, name + OLD))
            c.run(_rename(options, name + SIDE, name))
    with Connection(spark, options) as c:
        for name in tables:
            if c.has(name + OLD):
                c.run(f"DROP TABLE {name + OLD}")


def append_batch(spark: SparkSession, tables: Mapping[str, DataFrame], options: Mapping[str, str], batch_id: str) -> bool:
    """Append one batch to all tables, or, where it is recorded already, nothing.
    Returns whether rows were added."""
    _checked_names(*tables)
    if not re.fullmatch(r"[A-Za-z0-9_.:-]{1,200}", batch_id):
        raise ValueError(f"{batch_id!r} is no plain batch id")
    with Connection(spark, options) as c:
        if not c.has(BATCHES):
            c.run(f"CREATE TABLE {BATCHES} (batch_id VARCHAR(200) NOT NULL PRIMARY KEY)")
        if c.value(f"SELECT batch_id FROM {BATCHES} WHERE batch_id = '{batch_id}'") is not None:
            return False
    _load(tables, options)
    with Connection(spark, options) as c:
        # the primary key refuses a second load of the same batch at the same time
        c.run(f"INSERT INTO {BATCHES} VALUES ('{batch_id}')")
        for name, df in tables.items():
            if c.has(name):
                columns = ", ".join(f'"{n}"' for n in df.columns)
                c.run(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {name + SIDE}")
                c.run(f"DROP TABLE {name + SIDE}")
            else:
                c.run(_rename(options, name + SIDE, name))
    return True
