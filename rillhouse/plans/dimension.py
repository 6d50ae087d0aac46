"""Dimension tables kept in step with their sources, driven by a configuration table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import names as N
from ..functions.messages import cdc_data_schema
from ..functions.types import DimensionMeta, dimension_meta
from ..operators import cdc
from ..operators.merge import STRICT, UPSERT, stringify
from ..sources.tables import KeyedTable, MergedTable, cached

CONFIG_REQUIRED = ["id", "source_table", "sink_table", "row_key", "schema", "to_hbase"]
ORDER = "_order"


def with_order(messages: DataFrame) -> DataFrame:
    """Number the messages of one micro-batch in the order they were read.

    That order is right for one file or one topic partition only. Sources of several bring
    their own as ``_order`` (``ordered=True`` of the message readers); a place in files is
    completed by the row's number.
    """
    row = F.monotonically_increasing_id()
    kind = dict(messages.dtypes).get(ORDER)
    if kind is None:
        return messages.withColumn(ORDER, row)
    if kind.startswith("struct"):
        return messages.withColumn(ORDER, F.struct(f"{ORDER}.*", row.alias("row")))
    return messages


def _changes(messages: DataFrame) -> DataFrame:
    ordered = with_order(messages)
    return ordered.select(F.json_tuple("value", *cdc.ENVELOPE).alias(*cdc.ENVELOPE), ORDER)


def config_changes(messages: DataFrame, database: str | None = None) -> DataFrame:
    """Changes of the configuration table; rows lacking a required value are dropped."""
    rows = cdc.of_table(cdc.without_control(_changes(messages)), N.CONFIG_TABLE, (), database)
    bound = cdc.bind(rows, cdc_data_schema(N.CONFIG_TABLE), "type", "ts", ORDER)
    timed = bound.withColumn("time", F.timestamp_seconds(F.col("ts").try_cast("bigint"))).drop("ts")
    return timed.na.drop(subset=[*CONFIG_REQUIRED, "type", "time"])


def config_table(path: str) -> MergedTable:
    schema = cdc_data_schema(N.CONFIG_TABLE).add("time", "timestamp")
    return MergedTable(path, schema)


def sync_config(messages: DataFrame, batch_id: int, table: MergedTable,
                database: str | None = None) -> None:
    """Merge one micro-batch of configuration changes; the table is made if it is absent."""
    table.create_if_absent(messages.sparkSession)
    with cached(config_changes(messages, database)) as changes:
        if not changes.isEmpty():
            table.merge(changes, batch_id, "id", ["time", ORDER], policy=UPSERT)


def configured(config: DataFrame, keyed_store: bool) -> Iterator[DimensionMeta]:
    """Decoded configuration rows of one kind of sink, last row per source table.

    There is one per dimension table; they are streamed to the driver one by one,
    because each is the plan of its own write.
    """
    wanted = F.col("to_hbase") != 0 if keyed_store else F.col("to_hbase") == 0
    rows = cdc.latest_per_key(config.where(wanted), ["source_table"], ["time", "id"])
    for row in rows.toLocalIterator():
        yield dimension_meta(row.asDict())


def dimension_changes(messages: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables, payload still text."""
    rows = cdc.configured_only(cdc.without_control(_changes(messages)), config)
    return rows.select("data", "table", F.col("type").alias("_type_"), ORDER)


def changed_tables(changes: DataFrame) -> set[str]:
    """Names of the configured tables that have changes in this micro-batch, in one job."""
    return {row["table"] for row in changes.select("table").distinct().toLocalIterator()}


def bound_changes(changes: DataFrame, meta: DimensionMeta) -> DataFrame:
    """Changes of one table, parsed with the schema its configuration row declares."""
    rows = changes.where(F.col("table") == meta.source_table)
    return cdc.bind(rows, meta.schema, "_type_", ORDER).where(F.col(meta.row_key).isNotNull())


def _each_changed(changes: DataFrame, config: DataFrame, keyed_store: bool,
                  apply: Callable[[DimensionMeta, DataFrame], None], parallel: int) -> list[str]:
    """Apply the changes of every touched table; the tables are independent jobs."""
    present = changed_tables(changes)
    metas = [m for m in configured(config, keyed_store) if m.source_table in present]
    with ThreadPool(parallel) as pool:
        pool.map(lambda meta: apply(meta, bound_changes(changes, meta)), metas, chunksize=1)
    return [meta.sink_table for meta in metas]


def sync_dimensions(messages: DataFrame, batch_id: int, config: DataFrame,
                    table: Callable[[DimensionMeta], MergedTable], parallel: int = 4) -> list[str]:
    """Merge one micro-batch into the merged dimension tables, which are made where they are
    absent; returns the tables touched."""
    def merge(meta: DimensionMeta, rows: DataFrame) -> None:
        store = table(meta)
        store.create_if_absent(rows.sparkSession)
        store.merge(rows, batch_id, meta.row_key, [ORDER], "_type_", STRICT)

    with cached(dimension_changes(messages, config.where(F.col("to_hbase") == 0))) as changes:
        return _each_changed(changes, config, False, merge, parallel)


def keyed_changes(rows: DataFrame, key: str, order_by: list[str], op: str = "_type_") -> DataFrame:
    """Last change per row key, cells as text, with ``_removed`` true for a delete."""
    last = cdc.latest_per_key(rows, [key], order_by)
    return (stringify(last.drop(*order_by), keep=[op])
            .withColumn("_removed", F.col(op) == N.DELETE).drop(op))


def sync_keyed_dimensions(messages: DataFrame, batch_id: int, config: DataFrame,
                          table: Callable[[DimensionMeta], KeyedTable], parallel: int = 4
                          ) -> list[str]:
    """Write one micro-batch into the row-keyed dimension tables.

    The last change of a key is its whole new row (or its removal), so nothing of the
    table is read; that suits dimensions too large to rewrite per batch.
    """
    def put(meta: DimensionMeta, rows: DataFrame) -> None:
        store = table(meta)
        store.compact_every(rows.sparkSession, batch_id)
        store.put(keyed_changes(rows, meta.row_key, [ORDER]), batch_id, gone="_removed")

    with cached(dimension_changes(messages, config.where(F.col("to_hbase") != 0))) as changes:
        return _each_changed(changes, config, True, put, parallel)
