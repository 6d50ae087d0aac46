"""The warehouse's running jobs: each method starts the queries of one job.

Paths are ``<root>/<layer>/<table>`` and ``<root>/checkpoints/<layer>/<table>``. The
two message topics are given as functions that open a stream, so any source with a
``value`` text will do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import names as N
from ..functions.text import tokenize
from ..functions.types import DimensionMeta
from ..sources import paths, tables
from ..sources.readers import MESSAGE, VersionedSnapshot, table_stream
from ..live import daily
from ..live.state import accept_and_flag_stream, device_store, flag_batch
from . import dimension, facts, metrics


@dataclass
class Warehouse:
    """Where the warehouse lives and how its streams run.

    Dimension frames are cached and loaded anew when the stored dimension has changed, so a
    new name shows in the next micro-batch. ``available_now`` stops each query at the end of
    its input.
    """

    spark: SparkSession
    root: str
    topic_db: Callable[[], DataFrame]
    topic_log: Callable[[], DataFrame]
    database: str | None = None
    available_now: bool = False
    trigger: str | None = None
    max_files: int | None = 5
    compact_every: int = 100
    buckets: int = 16
    _dims: dict[str, VersionedSnapshot] = field(default_factory=dict)

    # --- places ----------------------------------------------------------------------------

    def path(self, layer: str, table: str) -> str:
        return tables.table_path(self.root, layer, table)

    def checkpoint(self, layer: str, table: str) -> str:
        return tables.checkpoint_path(self.root, layer, table)

    def config(self) -> tables.MergedTable:
        return dimension.config_table(self.path(N.DIM, N.CONFIG_TABLE))

    def merged(self, meta: DimensionMeta) -> tables.MergedTable:
        return tables.MergedTable(self.path(N.DIM, meta.sink_table), meta.schema, meta.partition_by,
                                  self.buckets)

    def keyed(self, meta: DimensionMeta) -> tables.KeyedTable:
        texts = T.StructType([T.StructField(c, T.StringType()) for c in meta.schema.fieldNames()])
        return tables.KeyedTable(self.path(N.DIM, meta.sink_table), [meta.row_key],
                                 partition=None, schema=texts, buckets=self.buckets)

    def metric(self, table: str) -> tables.KeyedTable:
        return tables.KeyedTable(self.path(N.DWS, table), N.METRIC_KEYS[table])

    def _meta(self, table: str) -> DimensionMeta:
        config = self.config().read(self.spark).where(F.col("sink_table") == table)
        for keyed_store in (False, True):
            for meta in dimension.configured(config, keyed_store):
                return meta
        raise LookupError(f"no configuration row has the sink table {table!r}")

    def _stored(self, meta: DimensionMeta) -> tables.KeyedTable | tables.MergedTable:
        return self.keyed(meta) if meta.keyed_store else self.merged(meta)

    def read_dimension(self, table: str) -> DataFrame:
        """A dimension as its configuration row stores it."""
        return self._stored(self._meta(table)).read(self.spark)

    def dimension_for(self, table: str, rows: DataFrame, on: str) -> DataFrame:
        """Only the dimension rows that ``rows`` ask for, read now; for very large dimensions."""
        meta = self._meta(table)
        if meta.keyed_store:
            return self.keyed(meta).read_for(rows, on)
        return self.merged(meta).read_for(rows, on, meta.row_key)

    def dimension(self, table: str) -> DataFrame:
        """Cached dimension, loaded anew when a newer batch of it or of its configuration is stored."""
        if table not in self._dims:
            self._dims[table] = VersionedSnapshot(
                lambda: self.read_dimension(table),
                lambda: (self.config().version(self.spark),
                         self._stored(self._meta(table)).version(self.spark)))
        return self._dims[table].get()

    def _append(self, df: DataFrame, table: str) -> StreamingQuery:
        return tables.append_batches(df, self.path(N.DWD, table), self.checkpoint(N.DWD, table),
                                     available_now=self.available_now, trigger=self.trigger)

    def _each(self, df: DataFrame, layer: str, name: str,
              fn: Callable[[DataFrame, int], object]) -> StreamingQuery:
        return tables.each_batch(df, fn, self.checkpoint(layer, name), self.available_now,
                                 self.trigger)

    def _put(self, df: DataFrame, table: str,
             finish: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> StreamingQuery:
        store = self.metric(table)

        def write(batch: DataFrame, n: int) -> None:
            # Windows close in few micro-batches; most are empty.
            with tables.cached(batch) as closed:
                if not closed.isEmpty():
                    store.compact_every(self.spark, n, self.compact_every)
                    store.put(finish(closed), n)

        return self._each(df, N.DWS, table, write)

    def _no_messages(self) -> DataFrame:
        return self.spark.createDataFrame([], MESSAGE)

    def _facts(self, table: str, schema: T.StructType) -> DataFrame:
        """A fact table as a stream; each is written in a folder per micro-batch."""
        schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return table_stream(self.spark, self.path(N.DWD, table), schema, max_files=self.max_files)

    def compact_facts(self, settled_minutes: float = 60) -> dict[str, int]:
        """Join the small files of every fact table; how many files went into larger ones."""
        return {name: tables.compact_files(self.spark, self.path(N.DWD, name),
                                           settled_minutes=settled_minutes)
                for name in (*facts.LOG_TABLES, N.LOG_INVALID, N.DWD_ORDER_DETAIL, N.DWD_PAYMENT,
                             N.DWD_CART, N.DWD_COMMENT, N.DWD_USER)
                if paths.exists(self.spark, self.path(N.DWD, name))}

    # --- dimensions ------------------------------------------------------------------------

    def config_sync(self) -> StreamingQuery:
        return self._each(self.topic_db(), N.DIM, N.CONFIG_TABLE, lambda batch, n: (
            dimension.sync_config(batch, n, self.config(), self.database)))

    def dimension_sync(self) -> StreamingQuery:
        return self._each(self.topic_db(), N.DIM, "topic_db_merged", lambda batch, n: (
            dimension.sync_dimensions(batch, n, self.config().read(self.spark), self.merged)))

    def keyed_dimension_sync(self) -> StreamingQuery:
        return self._each(self.topic_db(), N.DIM, "topic_db_keyed", lambda batch, n: (
            dimension.sync_keyed_dimensions(batch, n, self.config().read(self.spark), self.keyed)))

    # --- facts -----------------------------------------------------------------------------

    def log_split(self, late_seconds: int = 5, trust_reported_old: bool = False,
                  corrected: bool = True) -> list[StreamingQuery]:
        """Quarantine, and the five log tables from one pass over the accepted lines."""
        messages = self.topic_log()
        # The device rule by table asks for a whole number; files have a compound order.
        numbered = dict(messages.dtypes).get(dimension.ORDER) == "bigint"
        valid, invalid = facts.split_log(messages, *([dimension.ORDER] if numbered else []))

        def sink(table: str) -> tables.Sink:
            return lambda df, n: tables.append_batch(df, self.path(N.DWD, table), batch_id=n)

        routes = {t: (select, sink(t)) for t, select in facts.LOG_TABLES.items()}

        def write(accepted: DataFrame, n: int) -> None:
            tables.route(facts.open_log(accepted, corrected), n, routes)

        def flag_and_write(batch: DataFrame, n: int) -> None:
            with tables.cached(batch) as rows:
                write(flag_batch(rows, n, devices, "ts", dimension.ORDER, "is_new", late_seconds,
                                 trust_reported_old), n)

        if numbered:
            devices = device_store(self.path(N.DWD, "device_records"), "mid", T.StringType())
            lines, step = valid, flag_and_write
        else:
            lines = accept_and_flag_stream(valid, "mid", "ts", "is_new", late_seconds,
                                           trust_reported_old)
            step = write
        return [self._append(invalid, N.LOG_INVALID), self._each(lines, N.DWD, N.TOPIC_LOG, step)]

    def order_details(self) -> StreamingQuery:
        return self._append(facts.order_details(self.topic_db(), self.database), N.DWD_ORDER_DETAIL)

    def order_schema(self) -> T.StructType:
        return facts.order_details(self._no_messages()).schema

    def payments(self) -> StreamingQuery:
        orders = self._facts(N.DWD_ORDER_DETAIL, self.order_schema())
        joined = facts.payments_with_orders(facts.paid(self.topic_db(), self.database), orders)

        def write(batch: DataFrame, n: int) -> None:
            with tables.cached(batch) as rows:
                if not rows.isEmpty():
                    named = facts.name_payments(rows, self.dimension(N.DIM_BASE_DIC),
                                                self.dimension_for(N.DIM_USER_INFO, rows, "user_id"))
                    tables.append_batch(named, self.path(N.DWD, N.DWD_PAYMENT), evolve=True,
                                        batch_id=n)

        return self._each(joined, N.DWD, N.DWD_PAYMENT, write)

    def carts(self) -> StreamingQuery:
        return self._append(facts.cart_adds(self.topic_db(), self.database), N.DWD_CART)

    def comments(self) -> StreamingQuery:
        """Names come from the dictionary as it is for each micro-batch."""
        raw = facts.comment_rows(self.topic_db(), self.database)

        def write(batch: DataFrame, n: int) -> None:
            named = facts.name_comments(batch, self.dimension(N.DIM_BASE_DIC))
            with tables.cached(named) as rows:
                tables.append_batch(rows, self.path(N.DWD, N.DWD_COMMENT), batch_id=n)

        return self._each(raw, N.DWD, N.DWD_COMMENT, write)

    def users(self) -> StreamingQuery:
        return self._append(facts.registered_users(self.topic_db(), self.database), N.DWD_USER)

    # --- metrics ---------------------------------------------------------------------------

    def _by_table(self, rows: DataFrame, name: str, keys: Sequence[str], columns: str,
                  step: Callable[[DataFrame, int, tables.KeyedTable], DataFrame],
                  windows: Callable[[DataFrame], DataFrame], table: str) -> list[StreamingQuery]:
        """Two streams: increments with the keys' last days kept in a table, then windows over them.

        Where streams stop at the end of their input, the first is awaited before the second begins.
        """
        store = daily.visit_store(self.path(N.DWS, f"{name}_days"), dict.fromkeys(keys, T.StringType()),
                                  self.buckets)
        path = self.path(N.DWS, f"{name}_increments")
        first = daily.increments_stream(rows, lambda batch, n: step(batch, n, store), path,
                                        self.checkpoint(N.DWS, f"{name}_increments"),
                                        self.available_now, self.trigger)
        if self.available_now:
            first.awaitTermination()
        made = table_stream(self.spark, path, T.StructType.fromDDL(columns + ", batch bigint"),
                            max_files=self.max_files)
        return [first, self._put(windows(made.drop("batch")), table)]

    def page_views_by_table(self) -> list[StreamingQuery]:
        """``page_views`` without a state store or Python; for streams with very many devices."""
        return self._by_table(self.pages(), "page_views", ["mid"], metrics.PAGE_VIEW_INCREMENTS,
                              metrics.page_view_increments, metrics.page_view_windows,
                              "dws_traffic_page_view_count")

    def home_detail_by_table(self) -> list[StreamingQuery]:
        return self._by_table(self.pages(), "home_detail", ["page_id", "mid"],
                              metrics.HOME_DETAIL_INCREMENTS, metrics.home_detail_increments,
                              metrics.home_detail_windows, "dws_traffic_home_detailPage_view_count")

    def cart_add_by_table(self) -> list[StreamingQuery]:
        carts = self._facts(N.DWD_CART, facts.cart_adds(self._no_messages()).schema)
        return self._by_table(carts, "cart_add", ["user_id"], metrics.CART_ADD_INCREMENTS,
                              metrics.cart_add_increments, metrics.cart_add_windows, "dws_trade_cart_add")

    def pages(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "value string, is_new string, ts timestamp")
        schema = facts.log_pages(facts.open_log(empty)).schema
        return self._facts(N.LOG_PAGE, schema)

    def search_keywords(self, split: Callable[[str | Column], Column] = tokenize) -> StreamingQuery:
        return self._put(metrics.search_keywords(self.pages(), split=split),
                         "dws_search_keyword_count")

    def page_views(self, salts: int = 8) -> StreamingQuery:
        return self._put(metrics.page_views(self.pages(), salts=salts),
                         "dws_traffic_page_view_count")

    def home_detail_visitors(self, salts: int = 8) -> StreamingQuery:
        return self._put(metrics.home_detail_visitors(self.pages(), salts=salts),
                         "dws_traffic_home_detailPage_view_count")

    def user_logins(self, salts: int = 8) -> StreamingQuery:
        return self._put(metrics.user_logins(self.pages(), salts=salts), "dws_user_login")

    def registrations(self) -> StreamingQuery:
        users = self._facts(N.DWD_USER, facts.registered_users(self._no_messages()).schema)
        return self._put(metrics.registrations(users), "dws_user_register")

    def cart_add_users(self, salts: int = 8) -> StreamingQuery:
        carts = self._facts(N.DWD_CART, facts.cart_adds(self._no_messages()).schema)
        return self._put(metrics.cart_add_users(carts, salts=salts), "dws_trade_cart_add")

    def payment_users(self, salts: int = 8) -> StreamingQuery:
        columns = "user_id string, payment_time timestamp, date string"
        paid = self._facts(N.DWD_PAYMENT, T.StructType.fromDDL(columns))
        return self._put(metrics.payment_users(paid, salts=salts), "dws_trade_payment_suc")

    def sku_orders(self, cached: bool = True) -> StreamingQuery:
        """Names from cached dimensions, or (``cached=False``, for very large ones) from the rows
        that the closed windows ask for, hop by hop."""
        details = self._facts(N.DWD_ORDER_DETAIL, self.order_schema())
        read = (lambda table, rows, on: self.dimension(table)) if cached else self.dimension_for
        return self._put(metrics.sku_orders(details), "dws_trade_sku_order",
                         lambda closed: metrics.name_sku_orders(closed, read))

    def province_orders(self) -> StreamingQuery:
        details = self._facts(N.DWD_ORDER_DETAIL, self.order_schema())
        return self._put(metrics.province_orders(details), "dws_trade_province_order",
                         lambda closed: metrics.name_province_orders(
                             closed, self.dimension(N.DIM_PROVINCE)))
