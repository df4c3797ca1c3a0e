"""Tables of a store in the session catalog: a database, external tables by name,
comments and properties (``SHOW TBLPROPERTIES``), partitions kept in step.

The store stays the owner of the files; a catalog entry only points at them, so
dropping it loses nothing.  A full-refresh table points at its current version,
an append table has its batch folders as partitions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tierflow.sinks.tables import TableStore


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema) -> str:
    return ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def publish(store: TableStore, name: str, database: str) -> str:
    """Create or update the catalog entry of a table; returns its qualified name."""
    spark: SparkSession = store.spark
    m = store.meta(name)
    schema = store.stored_schema(name)
    if schema is None:
        raise FileNotFoundError(f"table {name} has no schema yet")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    table = f"{_q(database)}.{_q(name.replace('/', '_'))}"
    there = spark.catalog.tableExists(table)
    if m.get("kind") == "snapshot":
        location = _text(f"{store.path(name)}/version={store.latest_version(name)}")
        if there and [(f.name, f.dataType) for f in spark.table(table).schema] != [(f.name, f.dataType) for f in schema]:
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
            there = False
        if there:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {location}")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"CREATE TABLE {table} ({_columns(schema)}) USING parquet LOCATION {location}")
    else:
        part = m.get("partition")
        keys = ([f"{_q(part)} STRING"] if part else []) + ["`batch_id` INT"]
        if not there:
            spark.sql(f"CREATE TABLE {table} ({_columns(schema)}, {', '.join(keys)}) USING parquet "
                      f"PARTITIONED BY ({', '.join(k.split(' ')[0] for k in keys)}) LOCATION {_text(store.path(name))}")
        else:
            have = set(spark.table(table).columns)
            new = [f for f in schema.fields if f.name not in have]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(
                    f"{_q(f.name)} {f.dataType.simpleString()}" for f in new) + ")")
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for value, batches in store.batches_by_partition(name).items():
            for b in batches:
                spec = f"{part}={value}/batch_id={b}" if part else f"batch_id={b}"
                if spec not in known:
                    at = f"{_q(part)} = {_text(value)}, `batch_id` = {b}" if part else f"`batch_id` = {b}"
                    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({at}) "
                              f"LOCATION {_text(f'{store.path(name)}/{spec}')}")
    if m.get("comment"):
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(m['comment'])}")
    if m.get("properties"):
        pairs = ", ".join(f"{_text(k)} = {_text(str(v))}" for k, v in sorted(m["properties"].items()))
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    return table
