"""Every query: name → function of (spark, data folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillhouse import names as N
from rillhouse.functions import dates
from rillhouse.functions.text import explode_words, register_split_keywords
from rillhouse.operators import cdc, merge, sketches, visits
from rillhouse.operators.joins import interval_join
from rillhouse.operators.windows import windowed_agg
from rillhouse.plans import dimension, facts, metrics
from rillhouse.sources import paths, readers, tables
from rillhouse.session import configure
from rillhouse.live import daily, late
from rillhouse.live.run import (await_any, drain, drain_to_scratch, observed_totals, state_partitions,
                                state_rows)
from rillhouse.live.state import accept_and_flag_stream, device_store, flag_batch

from . import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _out(df: DataFrame, *rounded: str) -> DataFrame:
    """Dates as text and sums to cents, so that results compare across engines."""
    as_text = {f.name: F.col(f.name).cast("string") for f in df.schema.fields
               if isinstance(f.dataType, T.DateType)}
    return df.withColumns({**as_text, **{c: F.round(c, 2) for c in rounded}})


# --- windowed metrics ----------------------------------------------------------------------

@query
def page_view_metrics(spark, sf):
    return _out(metrics.page_views(I.pages(I.events(spark, sf)), "1 hour"), "durSum")


@query
def home_detail_uv(spark, sf):
    return _out(metrics.home_detail_visitors(I.pages(I.events(spark, sf)), "1 hour"))


@query
def user_login_returning(spark, sf):
    return _out(metrics.user_logins(I.pages(I.events(spark, sf)), "1 hour"))


def _signups(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("id"), F.col("ts").alias("create_time"))


@query
def register_sliding(spark, sf):
    return _out(metrics.registrations(_signups(I.events(spark, sf)), "2 hours", "1 hour"))


def _carts(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(
        F.col("user_id").cast("string").alias("user_id"), I.micros("ts").alias("create_time"))


@query
def cart_add_users(spark, sf):
    return _out(metrics.cart_add_users(_carts(I.events(spark, sf)), "1 hour"))


def _purchases(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("payment_time"))


@query
def payment_success_users(spark, sf):
    return _out(metrics.payment_users(_purchases(I.events(spark, sf)), "1 hour"))


@query
def search_keyword_windows(spark, sf):
    return _out(metrics.search_keywords(I.pages(I.events(spark, sf)), "1 hour"))


@query
def keyword_count(spark, sf):
    texts = readers.spread(I.table(spark, sf, "documents").select("text"))
    words = explode_words(texts, "text")
    return words.groupBy("keyword").agg(F.count("*").alias("count"))


@query
def keyword_count_sql(spark, sf):
    """The same as SQL text: registered function, views and LATERAL VIEW EXPLODE."""
    register_split_keywords(spark)
    readers.spread(I.table(spark, sf, "documents")).createOrReplaceTempView("keyword_source")
    return spark.sql("""
        SELECT keyword, count(*) AS count
        FROM (SELECT splitKeywords(text) AS words FROM keyword_source)
        LATERAL VIEW EXPLODE(split(words, ',')) w AS keyword
        WHERE keyword <> '' GROUP BY keyword""")


@query
def sku_order_snowflake(spark, sf):
    orders = metrics.sku_orders(I.order_lines(spark, sf), "1 day")
    return _out(metrics.name_sku_orders(orders, I.sku_dimensions(spark, sf)), "totalOrderPrice")


@query
def province_orders_exact(spark, sf):
    orders = metrics.province_orders(I.province_details(spark, sf), "1 day", exact=True)
    return _out(metrics.name_province_orders(orders, I.provinces(spark, sf)), "totalOrderPrice")


@query
def province_orders_approx(spark, sf):
    orders = metrics.province_orders(I.province_details(spark, sf), "1 day")
    return _out(metrics.name_province_orders(orders, I.provinces(spark, sf)), "totalOrderPrice")


@query
def window_date_from_end(spark, sf):
    """Windows that reach midnight: the date of the end is the next day."""
    return _out(windowed_agg(I.events(spark, sf), "ts", "6 hours", [F.count("*").alias("n")],
                             ["event_type"], date_from="end"))


@query
def daily_first_visits(spark, sf):
    """Row level: first event of each user and day, with its type and the day before."""
    first = visits.first_of_day(I.events(spark, sf), "user_id", "ts", ["event_type"])
    first = first.select("user_id", I.micros("ts").alias("ts"), "event_type",
                         F.col("visit_date").cast("string").alias("visit_date"),
                         F.col("previous_date").cast("string").alias("previous_date"))
    return first


# --- joins ---------------------------------------------------------------------------------

@query
def order_wide_interval(spark, sf):
    wide = facts.order_details(I.order_messages(I.events(spark, sf)), around=3600)
    return wide.select("order_id", "sku_id", "sku_num", "order_price", "province_id", "activity_id",
                       "activity_rule_id", "coupon_id", I.micros("create_time").alias("create_time"),
                       "date")


def _payment_columns(df: DataFrame) -> DataFrame:
    return df.select("id", "order_id", "user_id", "payment_type", "total_amount",
                     I.micros("payment_time").alias("payment_time"), "sku_id", "payment_name",
                     "user_name", "date")


@query
def payment_wide(spark, sf):
    ev = I.events(spark, sf)
    paid = facts.paid(I.payment_messages(ev)).withColumnRenamed("id", "payment_id")
    joined = facts.payments_with_orders(paid, I.click_orders(ev), within=6 * 3600)
    named = facts.name_payments(joined, I.payment_dictionary(spark, sf), I.known_users(spark, sf))
    return _payment_columns(named.withColumnRenamed("payment_id", "id"))


@query
def interval_pairs_inner(spark, sf):
    """Clicks within the half hour after a view of the same user."""
    ev = I.events(spark, sf)
    clicks = ev.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", "ts")
    views = ev.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("ts").alias("view_ts"))
    # Slots of five minutes: a busy user's clicks of one half hour lie in six of them.
    pairs = interval_join(clicks, views, "user_id", "viewer", "ts", "view_ts", 0, 1800, slot_seconds=300)
    return pairs.select("click_id", "view_id")


@query
def semi_join_config(spark, sf):
    """Changes of configured tables only, counted per table and kind."""
    mixed = (I.user_messages(spark, sf).unionByName(I.user_messages(spark, sf, "base_province"))
             .unionByName(I.comment_messages(spark, sf)))
    config = I.table(spark, sf, "region").select(
        F.when(F.col("r_regionkey") == 0, "user_info").when(F.col("r_regionkey") == 1, "comment_info")
        .otherwise(F.concat(F.lit("other_"), F.col("r_name"))).alias("source_table"))
    kept = cdc.configured_only(cdc.without_control(cdc.envelope(mixed)), config)
    return kept.groupBy("table", "type").agg(F.count("*").alias("n"))


# --- change messages -----------------------------------------------------------------------

@query
def cdc_cart_delta(spark, sf):
    adds = facts.cart_adds(I.cart_messages(spark, sf))
    return (adds.groupBy("date", "sku_id")
            .agg(F.count("*").alias("n"), F.sum("sku_num").alias("sku_num"),
                 F.round(F.sum("cart_price"), 2).alias("cart_price")))


@query
def comment_dictionary(spark, sf):
    rows = facts.comments(I.comment_messages(spark, sf), I.appraisal_dictionary(spark, sf))
    return rows.select("id", "user_id", "appraise", "create_time", "date")


@query
def cdc_new_users(spark, sf):
    rows = facts.registered_users(I.user_messages(spark, sf))
    return rows.select("id", "name", "user_level",
                       F.date_format("create_time", dates.SECOND).alias("create_time"), "date")


@query
def cdc_control_filter(spark, sf):
    kept = cdc.without_control(cdc.envelope(I.user_messages(spark, sf)))
    return kept.groupBy("database", "table", "type").agg(F.count("*").alias("n"))


@query
def json_props(spark, sf):
    parsed = I.events(spark, sf).select(
        "event_id", F.from_json("props", "k bigint, missing string").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"),
                         F.coalesce("p.missing", F.lit("none")).alias("missing"))


@query
def latest_order_per_customer(spark, sf):
    orders = I.table(spark, sf, "orders")
    last = cdc.latest_per_key(orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"),
                              ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return last.withColumn("o_orderdate", F.date_format("o_orderdate", dates.DATE))


# --- merges --------------------------------------------------------------------------------

def _merged(spark, sf, policy) -> DataFrame:
    return merge.apply_changes(I.table(spark, sf, "customer"), I.customer_changes(spark, sf),
                               "c_custkey", ["seq"], policy=policy)


@query
def dim_merge_strict(spark, sf):
    return _merged(spark, sf, merge.STRICT)


@query
def dim_merge_upsert(spark, sf):
    return _merged(spark, sf, merge.UPSERT)


@query
def rowkey_replace(spark, sf):
    """Row-keyed table: all customers put, then the changes; cells are texts."""
    folder = paths.scratch(spark, "rowkey")
    store = tables.KeyedTable(folder, ["c_custkey"], partition=None)
    customers = I.table(spark, sf, "customer").withColumns(
        {"_type_": F.lit("bootstrap-insert"), "seq": F.lit(0)})
    store.put(dimension.keyed_changes(customers, "c_custkey", ["seq"]), 0, gone="_removed")
    changes = I.customer_changes(spark, sf).withColumnRenamed("type", "_type_")
    store.put(dimension.keyed_changes(changes, "c_custkey", ["seq"]), 1, gone="_removed")
    return store.read(spark)


@query
def metric_keyed_replace(spark, sf):
    """Hourly counts of all events replaced by those of the later recount (value > 50)."""
    ev = I.events(spark, sf)

    def counted(rows: DataFrame) -> DataFrame:
        return windowed_agg(rows, "ts", "1 hour", [F.count("*").alias("n")], ["event_type"])

    return _out(merge.upsert_replace(counted(ev), counted(ev.where("value > 50")),
                                     ["startTime", "endTime", "date", "event_type"]))


@query
def keyed_table_batches(spark, sf):
    """The same replacement through a stored table: two batches, one replayed, then compacted."""
    ev = I.events(spark, sf)
    store = tables.KeyedTable(paths.scratch(spark, "metric"),
                              ["startTime", "endTime", "date", "event_type"])

    def counted(rows: DataFrame) -> DataFrame:
        return windowed_agg(rows, "ts", "1 hour", [F.count("*").alias("n")], ["event_type"])

    store.put(counted(ev), 0)
    store.put(counted(ev.where("value > 50")), 1)
    store.put(counted(ev.where("value > 50")), 1)
    store.compact(spark)
    return _out(store.read(spark)).select("startTime", "endTime", "date", "event_type", "n")


def _config_messages(spark, sf) -> DataFrame:
    """Configuration rows for the customer dimension, one per region, as change messages."""
    layout = ('[{"name":"id","type":"string"},{"name":"name","type":"string?"},'
              '{"name":"user_level","type":"string?"}]')
    region = I.table(spark, sf, "region")
    data = F.struct(
        F.col("r_regionkey").cast("string").alias("id"),
        F.concat(F.lit("dim_source_"), F.col("r_regionkey").cast("string")).alias("source_table"),
        F.concat(F.lit("dim_sink_"), F.col("r_regionkey").cast("string")).alias("sink_table"),
        F.lit("id").alias("row_key"), F.lit(layout).alias("schema"),
        F.lit("info").alias("column_family"), (F.col("r_regionkey") % 2).cast("int").alias("to_hbase"))
    return region.select(F.lit(None).cast("string").alias("key"), F.to_json(F.struct(
        F.lit("shop").alias("database"), F.lit(N.CONFIG_TABLE).alias("table"),
        F.lit("insert").alias("type"), data.alias("data"), F.lit(1_700_000_000).alias("ts"))
    ).alias("value"))


def _configured(spark, sf) -> DataFrame:
    config = dimension.config_table(paths.scratch(spark, "config"))
    dimension.sync_config(_config_messages(spark, sf), 0, config)
    return config.read(spark)


def _customer_messages(spark, sf, kind: str = I.USER_KIND, name: str = "c_name") -> DataFrame:
    """Customers as changes of five source tables, by key."""
    customers = I.table(spark, sf, "customer").withColumn("kind", F.expr(kind)).where("kind IS NOT NULL")
    source = F.concat(F.lit("dim_source_"), (F.col("c_custkey") % 5).cast("string"))
    data = F.struct(F.col("c_custkey").cast("string").alias("id"), F.expr(name).alias("name"),
                    F.col("c_mktsegment").alias("user_level"), F.col("c_acctbal").alias("unlisted"))
    return customers.select(F.lit(None).cast("string").alias("key"), F.to_json(F.struct(
        F.lit("shop").alias("database"), source.alias("table"), F.col("kind").alias("type"),
        data.alias("data"))).alias("value"))


def _later_messages(spark, sf) -> DataFrame:
    """A second batch of changes: three quarters of all keys updated, deleted or inserted (again)."""
    return _customer_messages(
        spark, sf, "CASE c_custkey % 4 WHEN 0 THEN 'update' WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' END",
        "concat(c_name, CASE c_custkey % 4 WHEN 0 THEN '*' ELSE '+' END)")


@query
def dimension_config(spark, sf):
    """Two batches of configuration changes: rows created, then one moved and one removed."""
    config = dimension.config_table(paths.scratch(spark, "config"))
    messages = _config_messages(spark, sf)
    dimension.sync_config(messages, 0, config)
    later = F.replace(F.replace("value", F.lit("1700000000"), F.lit("1700000001")),
                      F.lit("dim_sink_"), F.lit("moved_"))
    for key, kind in (("3", "update"), ("4", "delete")):
        messages = messages.union(_config_messages(spark, sf).where(
            F.get_json_object("value", "$.data.id") == key).select("key", F.replace(
                later, F.lit('"type":"insert"'), F.lit(f'"type":"{kind}"')).alias("value")))
    dimension.sync_config(messages, 1, config)
    return config.read(spark).select(
        "id", "source_table", "sink_table", "row_key", "to_hbase",
        F.date_format("time", dates.SECOND).alias("time"))


@query
def dimension_sync(spark, sf):
    """Configuration, then two batches of changes into the merged dimension tables, the second of
    updates, deletes and inserts over stored rows; it is replayed once."""
    config, root = _configured(spark, sf), paths.scratch(spark, "dims")

    def place(meta):
        return tables.MergedTable(f"{root}/{meta.sink_table}", meta.schema, meta.partition_by, buckets=4)

    dimension.sync_dimensions(_customer_messages(spark, sf), 0, config, place)
    for _ in range(2):
        dimension.sync_dimensions(_later_messages(spark, sf), 1, config, place)
    return _all_tables(spark, config, False, lambda meta: place(meta).read(spark))


@query
def dimension_sync_keyed(spark, sf):
    """The same for the row-keyed dimension tables, whose last change is the whole row."""
    config, root = _configured(spark, sf), paths.scratch(spark, "keyed-dims")

    def place(meta):
        return tables.KeyedTable(f"{root}/{meta.sink_table}", [meta.row_key], partition=None, buckets=4)

    dimension.sync_keyed_dimensions(_customer_messages(spark, sf), 0, config, place)
    for _ in range(2):
        dimension.sync_keyed_dimensions(_later_messages(spark, sf), 1, config, place)
    return _all_tables(spark, config, True, lambda meta: place(meta).read(spark))


@query
def dimension_sync_files(spark, sf):
    """Changes of a short older file and a long newer one in one batch: the newer ones win."""
    config, root = _configured(spark, sf), paths.scratch(spark, "file-dims")
    inbox, customers = paths.scratch(spark, "inbox"), I.table(spark, sf, "customer")
    source = F.concat(F.lit("dim_source_"), (F.col("c_custkey") % 5).cast("string"))
    longer = F.concat("c_name", F.lit(" as the newer file has it"))
    for rows, name in ((customers, F.lit("old")), (customers.where("c_custkey % 4 <> 0"), longer)):
        I.cdc_messages(rows, source, F.lit("insert"), [
            F.col("c_custkey").cast("string").alias("id"), name.alias("name"),
            F.col("c_mktsegment").alias("user_level")]).select("value").write.mode("append").text(inbox)

    def place(meta):
        return tables.KeyedTable(f"{root}/{meta.sink_table}", [meta.row_key], partition=None)

    dimension.sync_keyed_dimensions(readers.messages(spark, inbox, ordered=True), 0, config, place)
    return _all_tables(spark, config, True, lambda meta: place(meta).read(spark))


def _all_tables(spark, config, keyed: bool, read) -> DataFrame:
    parts = [read(meta).withColumn("sink_table", F.lit(meta.sink_table))
             for meta in dimension.configured(config, keyed)]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


# --- behaviour log -------------------------------------------------------------------------

def _flagged_log(spark, sf) -> DataFrame:
    """Accepted log lines with the device flag, opened for the fact tables."""
    ev = I.events(spark, sf).withColumn("arrival", F.expr(I.ARRIVAL))
    valid, _ = facts.split_log(I.log_messages(ev, "arrival"), "arrival")
    accepted = visits.accept_and_flag(valid, "mid", "ts", "arrival")
    return facts.open_log(accepted)


@query
def log_valid(spark, sf):
    valid, _ = facts.split_log(I.log_messages(I.events(spark, sf)))
    return valid.select("mid", "is_new", F.date_format("ts", dates.SECOND).alias("ts"))


def _set_aside(invalid: DataFrame) -> DataFrame:
    """Quarantined lines; their processing date is that of today."""
    today = F.col("date").cast("string") == F.date_format(F.current_date(), dates.DATE)
    return invalid.select("value", today.alias("today"))


@query
def log_invalid(spark, sf):
    _, invalid = facts.split_log(I.log_messages(I.events(spark, sf)))
    return _set_aside(invalid)


@query
def log_pages(spark, sf):
    return facts.log_pages(_flagged_log(spark, sf)).select(
        "ar", "ch", "is_new", "mid", "uid", "vc", "page_id", "last_page_id", "during_time",
        F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def log_starts(spark, sf):
    return facts.log_starts(_flagged_log(spark, sf)).select(
        "mid", "is_new", "entry", "loading_time", F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def log_errors(spark, sf):
    return facts.log_errors(_flagged_log(spark, sf)).select(
        "error_code", "msg", F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def log_display_explode(spark, sf):
    return facts.log_displays(_flagged_log(spark, sf)).select(
        "mid", "is_new", "page_id", "display_type", "display_item", "display_item_type", "pos_seq",
        "pos_id", F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def log_action_explode(spark, sf):
    return facts.log_actions(_flagged_log(spark, sf)).select(
        "mid", "is_new", "page_id", "action_id", "action_item", "action_item_type",
        F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def log_route_counts(spark, sf):
    """One pass over the log written to its five tables, then counted per table and day."""
    root = paths.scratch(spark, "log")
    tables.route(_flagged_log(spark, sf), 0, {
        name: (select, lambda df, n, at=f"{root}/{name}": tables.append_batch(df, at, batch_id=n))
        for name, select in facts.LOG_TABLES.items()})
    counts = [spark.read.parquet(f"{root}/{name}").groupBy("date").agg(F.count("*").alias("n"))
              .select(F.lit(name).alias("table"), F.col("date").cast("string").alias("date"), "n")
              for name in facts.LOG_TABLES]
    first, *rest = counts
    for part in rest:
        first = first.unionByName(part)
    return first


def _device_rows(spark, sf) -> DataFrame:
    return I.events(spark, sf).select(
        "event_id", "user_id", "ts", F.expr(I.ARRIVAL).alias("arrival"),
        F.expr("CAST(event_id % 2 AS STRING)").alias("is_new"))


@query
def device_is_new(spark, sf):
    kept = visits.accept_and_flag(_device_rows(spark, sf), "user_id", "ts", "arrival", chunk_rows=1000)
    return kept.select("event_id", "user_id", "is_new")


@query
def device_is_new_trusting(spark, sf):
    kept = visits.accept_and_flag(_device_rows(spark, sf), "user_id", "ts", "arrival",
                                  trust_reported_old=True, chunk_rows=1000)
    return kept.select("event_id", "is_new")


@query
def device_late_drop(spark, sf):
    kept = visits.accept_and_flag(_device_rows(spark, sf), "user_id", "ts", "arrival", chunk_rows=1000)
    return kept.groupBy("user_id").agg(F.count("*").alias("kept"))


# --- keyed reads, appends, dates -----------------------------------------------------------

@query
def point_lookup(spark, sf):
    return readers.point_get(I.table(spark, sf, "customer"), "c_custkey", "42",
                             ["c_custkey", "c_name", "c_mktsegment"])


def _customers_by_text(spark, sf) -> DataFrame:
    """Customers stored in the order of their keys as texts."""
    path = paths.scratch(spark, "row-keys")
    customer = I.table(spark, sf, "customer").withColumns({
        "row_key": F.col("c_custkey").cast("string"),
        "segment": F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment"))})
    readers.write_row_keys(customer.select("row_key", "c_custkey", "c_name", "segment"), path, "row_key")
    return spark.read.parquet(path)


@query
def range_scan(spark, sf):
    return readers.range_scan(_customers_by_text(spark, sf), "row_key", "10", "2", ["c_custkey", "c_name"])


@query
def range_scan_filtered(spark, sf):
    return readers.range_scan_filtered(_customers_by_text(spark, sf), "row_key", "10", "2", "segment",
                                       "BUILDING", ["c_custkey", "c_name"])


def _evolved_orders(spark, sf) -> str:
    path, orders = paths.scratch(spark, "evolve"), I.table(spark, sf, "orders")
    dated = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                          F.date_format("o_orderdate", "yyyy").alias("year"))
    old = dated.where("o_orderstatus = 'F'").drop("o_orderpriority")
    tables.append_batch(old, path, "year")
    tables.append_batch(dated.where("o_orderstatus <> 'F'"), path, "year", evolve=True)
    tables.append_batch(dated.where("o_orderstatus = 'none'"), path, "year")
    return path


@query
def append_evolved_schema(spark, sf):
    """Two appended batches, the second with one more column; an empty one writes nothing."""
    rows = readers.snapshot(spark, _evolved_orders(spark, sf), merge_schema=True)
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                       F.col("year").cast("string").alias("year"))


@query
def stream_evolved_schema(spark, sf):
    """The same table as a stream, which sees the added column; micro-batches are limited by bytes."""
    rows = readers.table_stream(spark, _evolved_orders(spark, sf), max_bytes=10 << 20)
    return drain_to_scratch(rows.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                                        F.col("year").cast("string").alias("year")), "evolved")


@query
def partition_overwrite(spark, sf):
    """Overwriting with one year of rows replaces that year and leaves the others."""
    path = paths.scratch(spark, "overwrite")
    dated = I.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("year"))
    tables.append_batch(dated, path, "year")
    tables.append_batch(dated.where("year = '1997'").withColumn("o_orderstatus", F.lit("again")), path,
                        "year", mode="overwrite")
    return spark.read.parquet(path).groupBy("year", "o_orderstatus").agg(F.count("*").alias("n")) \
        .withColumn("year", F.col("year").cast("string"))


@query
def compacted_files(spark, sf):
    """A table written in small files, one segment of it compacted; the rows are the same."""
    path = paths.scratch(spark, "compact")
    part = I.table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    part.repartition(8).write.partitionBy("p_type").parquet(path)
    tables.compact_files(spark, path, settled_minutes=0, where=F.col("folder") == "/p_type=ECONOMY")
    return spark.read.parquet(path)


@query
def compacted_fact_files(spark, sf):
    """Facts written by four batches and by a stream of four micro-batches, with a newer one that is
    left alone, then compacted: rows per day and files left, which are fewer."""
    root = paths.scratch(spark, "facts")
    date = F.date_format("ts", dates.DATE).alias("date")
    ev = I.events(spark, sf).select("event_id", date)
    for n in range(4):
        tables.append_batch(ev.where(F.col("event_id") % 4 == n), f"{root}/facts", batch_id=n)
    stream = event_stream(spark, sf, "event_id % 4").select("event_id", date)
    with state_partitions(spark):
        tables.append_batches(stream, f"{root}/stream", f"{root}/checkpoint", available_now=True).awaitTermination()
    counted = []
    for name in ("facts", "stream"):
        path = f"{root}/{name}"
        tables.append_batch(spark.createDataFrame([(-1, "none")], "event_id long, date string"), path, batch_id=9)
        before = _files_by_date(spark, path)
        tables.compact_files(spark, path, settled_minutes=0)
        after = _files_by_date(spark, path)
        rows = spark.read.schema("event_id long, date string").parquet(path).groupBy("date").agg(
            F.count("*").alias("n"))
        counted.append(rows.join(before.withColumnRenamed("files", "files_before"), "date")
                       .join(after.withColumnRenamed("files", "files_after"), "date")
                       .select(F.lit(name).alias("table"), "date", "n", "files_after",
                               (F.col("files_after") < F.col("files_before")).alias("fewer")))
    return counted[0].unionByName(counted[1]).where("date <> 'none'")


def _files_by_date(spark, path) -> DataFrame:
    """How many files hold rows of each date, as they are now."""
    rows = spark.read.schema("event_id long, date string").parquet(path)
    counts = rows.groupBy("date").agg(F.count_distinct("_metadata.file_path").alias("files")).collect()
    return spark.createDataFrame([tuple(r) for r in counts], "date string, files long")   # one row a day


@query
def keyed_lookup_for_batch(spark, sf):
    """Names of the users of one event kind, read from a row-keyed table by key."""
    store = tables.KeyedTable(paths.scratch(spark, "users"), ["id"], partition=None, buckets=8)
    users = I.known_users(spark, sf)
    store.put(users, 0)
    store.put(users.where("id % 2 = 0").withColumn("name", F.upper("name")), 1)
    asked = I.events(spark, sf).where("event_type = 'purchase'").select(
        F.col("user_id").cast("string").alias("user_id"))
    found = store.read_for(asked, "user_id")
    return asked.join(found, asked["user_id"] == found["id"], "left").groupBy("user_id", "name") \
        .agg(F.count("*").alias("n")).withColumn("name", F.coalesce("name", F.lit("")))


@query
def date_functions(spark, sf):
    ev = I.events(spark, sf)
    millis = F.unix_millis("ts")
    dashed = F.date_format("ts", dates.DASHED_SECOND)
    return ev.select(
        "event_id", dates.date_text("ts").alias("day"),
        F.date_format(dates.millis_to_seconds_ts(millis), dates.SECOND).alias("second"),
        dates.millis_date_text(millis).alias("millis_day"),
        dates.add_days_text(dates.date_text("ts"), -1).alias("day_before"),
        dates.seconds_between(F.lit("2024-01-01 00-00-00"), dashed).alias("seconds"),
        dates.days_between(F.lit("2024-01-01"), dates.date_text("ts")).cast("bigint").alias("days"))


# --- streams -------------------------------------------------------------------------------

#: Micro-batches the staged events make, and rows of a staged file; of one whose rows cost much each.
STAGED_SLICES, STAGED_FILE_ROWS, SMALL_FILE_ROWS = 4, 500_000, 100_000
TIME = "unix_micros(CAST(ts AS TIMESTAMP))"


def event_stream(spark: SparkSession, sf: str, by: str = TIME,
                 file_rows: int = STAGED_FILE_ROWS) -> DataFrame:
    """All events as a stream of several micro-batches, in the order of a whole number ``by``.

    The range of ``by`` is cut into slices of equal width, written one after the other; a slice
    is one micro-batch of as many files as the rows ask for.
    """
    path = paths.scratch(configure(spark), "event-files")
    events = spark.read.parquet(f"{sf}/events.parquet")
    ends = events.agg(F.min(F.expr(by)).alias("low"), F.max(F.expr(by)).alias("high"),
                      F.count(F.lit(1)).alias("rows")).first()
    low, width = ends.low or 0, ((ends.high or 0) - (ends.low or 0)) // STAGED_SLICES + 1
    files = max(1, -(-ends.rows // (STAGED_SLICES * file_rows)))
    place = F.expr(by)
    for nth in range(STAGED_SLICES):
        begin = low + nth * width
        # Rows without a place come first.
        mine = ((place >= begin) & (place < begin + width)) | (
            place.isNull() if nth == 0 else F.lit(False))
        (events.where(mine).repartitionByRange(files, place).sortWithinPartitions(place)
         .write.mode("append").parquet(path))
    stream = readers.table_stream(spark, path, events.schema, max_files=files)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _through_increments(rows: DataFrame, keys: list[str], columns: str, step, windows) -> DataFrame:
    """A stream drained into increments, with the keys' days in a table, then windows over these."""
    spark = configure(rows.sparkSession)
    folder = paths.scratch(spark, "increments")
    store = daily.visit_store(f"{folder}/days", {k: T.StringType() for k in keys}, buckets=4)
    with state_partitions(spark):
        daily.increments_stream(rows, lambda batch, n: step(batch, n, store), f"{folder}/increments",
                                f"{folder}/checkpoint", available_now=True).awaitTermination()
        stream = readers.table_stream(spark, f"{folder}/increments",
                                      T.StructType.fromDDL(columns + ", batch bigint"), max_files=1)
        return drain_to_scratch(windows(stream.drop("batch")), "windows")


@query
def stream_page_view_metrics(spark, sf):
    views = _through_increments(
        I.pages(event_stream(spark, sf)), ["mid"], metrics.PAGE_VIEW_INCREMENTS,
        metrics.page_view_increments, lambda made: metrics.page_view_windows(made, "1 hour"))
    return _out(views, "durSum")


@query
def stream_home_detail_uv(spark, sf):
    return _out(_through_increments(
        I.pages(event_stream(spark, sf)), ["page_id", "mid"], metrics.HOME_DETAIL_INCREMENTS,
        metrics.home_detail_increments, lambda made: metrics.home_detail_windows(made, "1 hour")))


@query
def stream_home_detail_state(spark, sf):
    """The same by the state processor, with salted first stages."""
    return _out(drain_to_scratch(
        metrics.home_detail_visitors(I.pages(event_stream(spark, sf, file_rows=SMALL_FILE_ROWS)), "1 hour",
                                     salts=4), "home"))


@query
def stream_user_login_returning(spark, sf):
    logins = metrics.user_logins(I.pages(event_stream(spark, sf)), "1 hour")
    return _out(drain_to_scratch(logins, "logins"))


@query
def stream_register_sliding(spark, sf):
    return _out(drain_to_scratch(
        metrics.registrations(_signups(event_stream(spark, sf)), "2 hours", "1 hour"), "register"))


@query
def stream_cart_add_users(spark, sf):
    return _out(_through_increments(
        _carts(event_stream(spark, sf)), ["user_id"], metrics.CART_ADD_INCREMENTS,
        metrics.cart_add_increments, lambda made: metrics.cart_add_windows(made, "1 hour")))


@query
def stream_payment_success_users(spark, sf):
    return _out(drain_to_scratch(
        metrics.payment_users(_purchases(event_stream(spark, sf)), "1 hour"), "payers"))


@query
def stream_search_keyword_windows(spark, sf):
    return _out(drain_to_scratch(
        metrics.search_keywords(I.pages(event_stream(spark, sf)), "1 hour"), "keywords"))


@query
def stream_order_wide_interval(spark, sf):
    wide = facts.order_details(I.order_messages(event_stream(spark, sf, file_rows=SMALL_FILE_ROWS)), around=3600)
    return drain_to_scratch(wide.select(
        "order_id", "sku_id", "sku_num", "order_price", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", I.micros("create_time").alias("create_time"), "date"), "wide")


@query
def stream_payment_wide(spark, sf):
    ev = event_stream(spark, sf)
    paid = facts.paid(I.payment_messages(ev)).withColumnRenamed("id", "payment_id")
    joined = facts.payments_with_orders(paid, I.click_orders(ev), within=6 * 3600)
    rows = drain_to_scratch(joined, "payments")
    named = facts.name_payments(rows, I.payment_dictionary(spark, sf), I.known_users(spark, sf))
    return _payment_columns(named.withColumnRenamed("payment_id", "id"))


@query
def stream_device_is_new(spark, sf):
    rows = event_stream(spark, sf, I.ARRIVAL).select(
        "event_id", "user_id", "ts", F.expr(I.ARRIVAL).alias("arrival"),
        F.expr("CAST(event_id % 2 AS STRING)").alias("is_new"))
    return _flagged_stream(rows, "user_id").select("event_id", "user_id", "is_new")


def _flagged_stream(rows: DataFrame, device: str) -> DataFrame:
    """Numbered rows streamed through the device rule into a table, read back."""
    spark = configure(rows.sparkSession)
    folder = paths.scratch(spark, "flagged")
    store = device_store(f"{folder}/devices", device, rows.schema[device].dataType)

    def write(batch: DataFrame, n: int) -> None:
        with tables.cached(batch) as held:
            accepted = flag_batch(held, n, store, "ts", "arrival")
            tables.append_batch(accepted.withColumn("day", F.to_date("ts")), f"{folder}/rows", "day",
                                batch_id=n)

    with state_partitions(spark):
        tables.each_batch(rows, write, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@query
def stream_device_delivered(spark, sf):
    """The same rule as a state processor: rows in the order they are delivered."""
    rows = event_stream(spark, sf).select("event_id", "user_id", "ts", F.lit("1").alias("is_new"))
    kept = accept_and_flag_stream(rows, "user_id", "ts")
    return drain_to_scratch(kept.select("event_id", "user_id", "is_new"), "device")


@query
def stream_log_pages(spark, sf):
    """The log stream: device state, then the page table out of the accepted lines."""
    ev = event_stream(spark, sf, I.ARRIVAL, SMALL_FILE_ROWS).withColumn("arrival", F.expr(I.ARRIVAL))
    valid, _ = facts.split_log(I.log_messages(ev, "arrival"), "arrival")
    accepted = _flagged_stream(valid, "mid")
    return facts.log_pages(facts.open_log(accepted)).select(
        "ar", "ch", "is_new", "mid", "uid", "vc", "page_id", "last_page_id", "during_time",
        F.date_format("ts", dates.SECOND).alias("ts"), "date")


@query
def stream_log_invalid(spark, sf):
    _, invalid = facts.split_log(I.log_messages(event_stream(spark, sf)))
    folder = paths.scratch(configure(spark), "invalid")
    with state_partitions(spark):
        tables.append_stream(invalid, f"{folder}/table", f"{folder}/checkpoint", "date",
                             available_now=True).awaitTermination()
    return _set_aside(spark.read.schema(invalid.schema).parquet(f"{folder}/table"))


@query
def stream_sku_orders(spark, sf):
    """Click events as order lines, named after the windows close."""
    lines = event_stream(spark, sf).where("event_type = 'click'").select(
        F.col("event_id").cast("string").alias("sku_id"), F.lit(2).alias("sku_num"),
        F.col("value").alias("order_price"), F.col("ts").alias("create_time"))
    closed = drain_to_scratch(metrics.sku_orders(lines, "1 hour"), "sku")
    return _out(metrics.name_sku_orders(closed, I.sku_dimensions(spark, sf)), "totalOrderPrice")


@query
def stream_keyed_metric_table(spark, sf):
    """Registrations streamed into a keyed replace table."""
    folder = paths.scratch(configure(spark), "metric-stream")
    store = tables.KeyedTable(f"{folder}/table", N.METRIC_KEYS["dws_user_register"])
    metric = metrics.registrations(_signups(event_stream(spark, sf)), "2 hours", "1 hour")
    with state_partitions(spark):
        tables.metric_stream(metric, store, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return _out(store.read(spark)).select("startTime", "endTime", "date", "registerCt")


def message_files(messages: DataFrame, label: str, slices: int = STAGED_SLICES,
                  file_rows: int = STAGED_FILE_ROWS) -> DataFrame:
    """Messages staged as text files and opened as a message stream of ``slices`` micro-batches,
    each of as many files as the rows ask for."""
    spark = configure(messages.sparkSession)
    path = paths.scratch(spark, label)
    files = max(1, -(-messages.count() // (slices * file_rows)))
    messages.select("value").repartition(slices * files).write.text(path)
    return readers.message_stream(spark, "text", path, {"maxFilesPerTrigger": str(files)})


def _appended(rows: DataFrame, label: str, date: str | None) -> DataFrame:
    """A fact stream appended in a folder per micro-batch, by date if given, and read back."""
    spark, folder = rows.sparkSession, paths.scratch(rows.sparkSession, label)
    with state_partitions(spark):
        tables.append_batches(rows, f"{folder}/table", f"{folder}/checkpoint", date, available_now=True)
        spark.streams.resetTerminated()
        await_any(spark)
        for running in spark.streams.active:
            running.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/table").select(*rows.columns)


@query
def stream_cart_delta(spark, sf):
    # The stand-in rows spread over thousands of dates, so the facts are not parted by them.
    adds = _appended(facts.cart_adds(message_files(I.cart_messages(spark, sf), "cart-messages")), "cart-facts", None)
    return (adds.groupBy("date", "sku_id")
            .agg(F.count("*").alias("n"), F.sum("sku_num").alias("sku_num"),
                 F.round(F.sum("cart_price"), 2).alias("cart_price")))


@query
def stream_new_users(spark, sf):
    rows = _appended(facts.registered_users(message_files(I.user_messages(spark, sf), "user-messages")),
                     "user-facts", "date")
    return rows.select("id", "name", "user_level",
                       F.date_format("create_time", dates.SECOND).alias("create_time"), "date")


@query
def stream_comment_dictionary(spark, sf):
    """Comments named in each micro-batch from a stored dictionary, which is read anew when it is
    older than the refreshing allows."""
    raw = facts.comment_rows(message_files(I.comment_messages(spark, sf), "comment-messages"))
    folder = paths.scratch(spark, "comments")
    I.appraisal_dictionary(spark, sf).write.parquet(f"{folder}/dictionary")
    names = readers.RefreshingSnapshot(lambda: readers.snapshot(spark, f"{folder}/dictionary"), minutes=0)

    def write(batch: DataFrame, n: int) -> None:
        with tables.cached(facts.name_comments(batch, names.get())) as named:
            tables.append_batch(named, f"{folder}/table", None, batch_id=n)

    with state_partitions(spark):
        tables.each_batch(raw, write, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return readers.snapshot(spark, f"{folder}/table").select(
        "id", "user_id", "appraise", "create_time", F.col("date").cast("string").alias("date"))


def _province_lines(ev: DataFrame) -> DataFrame:
    """Clicks and purchases as order lines of provinces; several lines make an order."""
    return ev.where("event_type IN ('click', 'purchase')").select(
        F.expr("CAST(floor(event_id / 3) AS STRING)").alias("order_id"),
        F.expr("CAST(user_id % 5 AS STRING)").alias("province_id"),
        F.col("value").alias("order_price"), F.col("ts").alias("create_time"))


@query
def stream_province_orders(spark, sf):
    """Orders per province and six hours into a metric table, batch by batch; the approximate counts
    are held against exact ones."""
    spark = configure(spark)
    folder = paths.scratch(spark, "provinces")
    store = tables.KeyedTable(f"{folder}/metric", N.METRIC_KEYS["dws_trade_province_order"])
    closed = metrics.province_orders(_province_lines(event_stream(spark, sf)), "6 hours")

    def write(batch: DataFrame, n: int) -> None:
        with tables.cached(batch) as rows:
            if not rows.isEmpty():
                store.put(metrics.name_province_orders(rows, I.provinces(spark, sf)), n)

    with state_partitions(spark):
        tables.each_batch(closed, write, f"{folder}/checkpoint", available_now=True).awaitTermination()
    exact = metrics.province_orders(_province_lines(I.events(spark, sf)), "6 hours", exact=True)
    exact = exact.select("startTime", F.col("province_id").alias("provinceId"),
                         F.col("totalOrderNum").alias("exact"))
    near = F.abs(F.col("totalOrderNum") - F.col("exact")) <= 0.2 * F.col("exact") + 0.5
    return _out(store.read(spark).join(exact, ["startTime", "provinceId"]).select(
        "startTime", "endTime", "date", "provinceId", "provinceName",
        F.col("exact").alias("orders"), near.alias("near"), "totalOrderPrice"), "totalOrderPrice")


@query
def province_orders_sketch(spark, sf):
    """Daily sketches of orders per province, stored, then united per month and nation-wide."""
    path = paths.scratch(spark, "sketches")
    details = I.province_details(spark, sf)
    sketches.windowed_sketches(details, "create_time", "1 day", "order_id", ["province_id"]) \
        .write.parquet(path)
    month = F.date_format("date", "yyyy-MM").alias("month")
    parts = []
    for keys, names in (([month, "province_id"], ["month", "province_id"]), ([month], ["month"])):
        estimated = sketches.united(spark.read.parquet(path), keys).select(
            *names, sketches.estimate().alias("estimated"))
        exact = details.where("province_id IS NOT NULL").withColumn(
            "month", F.date_format("create_time", "yyyy-MM")).groupBy(*names).agg(
            F.count_distinct("order_id").alias("orders"))
        parts.append(estimated.join(exact, names).select(
            "month", (F.col("province_id") if len(names) > 1 else F.lit("all")).alias("province"), "orders",
            sketches.within_error(F.col("estimated"), F.col("orders")).alias("near")))
    return parts[0].unionByName(parts[1])


@query
def stream_state_days(spark, sf):
    """Logins streamed to the end, then the state read as a table: keys by the day of their last login."""
    spark = configure(spark)
    folder = paths.scratch(spark, "state")
    logins = I.pages(event_stream(spark, sf)).where("uid IS NOT NULL AND last_page_id IS NULL")
    first = visits.first_of_day(logins.select("uid", "ts"), "uid", "ts")
    drain(first, f"{folder}/table", f"{folder}/checkpoint")
    held = state_rows(spark, f"{folder}/checkpoint", "transformWithState", "last_day")
    day = F.date_from_unix_date("value.day").cast("string").alias("last_day")
    return held.groupBy(day).agg(F.count("*").alias("keys"))


@query
def stream_log_observed(spark, sf):
    """Valid and invalid log lines written apart in one pass, and counted on the way."""
    spark = configure(spark)
    folder = paths.scratch(spark, "observed")
    lines = facts.classified_log(I.log_messages(event_stream(spark, sf)))
    watched = lines.observe("log_lines", F.count_if("valid").alias("valid"),
                            F.count_if(~F.col("valid")).alias("invalid"))
    with state_partitions(spark):
        run = tables.append_stream(watched, f"{folder}/table", f"{folder}/checkpoint", "valid",
                                   available_now=True)
        run.awaitTermination()
    counted = spark.createDataFrame(list(observed_totals(run, "log_lines").items()), "kind string, observed long")
    written = spark.read.parquet(f"{folder}/table").groupBy(
        F.when(F.col("valid").cast("boolean"), "valid").otherwise("invalid").alias("kind")).agg(F.count("*").alias("written"))
    return counted.join(written, "kind", "left").na.fill(0, ["written"])


#: Every 97th event comes a week after its time.
LATE_PLACE = "unix_micros(CAST(ts AS TIMESTAMP)) + CASE WHEN event_id % 97 = 0 THEN 604800000000 ELSE 0 END"


@query
def stream_late_rows(spark, sf):
    """Rows behind the watermark set aside, the others counted by the hour."""
    spark = configure(spark)
    folder = paths.scratch(spark, "late")
    marks = late.high_marks(f"{folder}/marks")

    def write(batch: DataFrame, n: int) -> None:
        with tables.cached(batch) as rows:
            told = late.with_late(rows, n, marks, "ts", "1 minute")
            tables.append_batch(told, f"{folder}/rows", "late", batch_id=n)

    with state_partitions(spark):
        tables.each_batch(event_stream(spark, sf, LATE_PLACE).select("event_id", "event_type", "ts"), write,
                          f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("event_id", F.col("late").cast("boolean").alias("late"))


@query
def stream_late_dropped(spark, sf):
    """The same stream through daily windows, which drop rows of windows that have closed. A window
    closes by the newest time of the micro-batches before the one before."""
    spark = configure(spark)
    folder = paths.scratch(spark, "dropped")
    counted = windowed_agg(event_stream(spark, sf, LATE_PLACE), "ts", "1 day", [F.count("*").alias("n")],
                           ["event_type"], delay="1 minute")
    with state_partitions(spark):
        run = tables.append_stream(counted, f"{folder}/table", f"{folder}/checkpoint", None, available_now=True)
        run.awaitTermination()
    return _out(spark.read.schema(counted.schema).parquet(f"{folder}/table"))


@query
def catalog_table(spark, sf):
    """A table made if absent (twice), filled by INSERT … VALUES and by a batch, looked at, and dropped;
    its files stay."""
    name, path = f"regions_{uuid.uuid4().hex}", paths.scratch(spark, "catalog")
    region = I.table(spark, sf, "region").select("r_regionkey", "r_name")
    for _ in range(2):
        tables.create_table(spark, name, region.schema, path)
    region.where("r_regionkey >= 2").write.mode("append").insertInto(name)
    for row in region.where("r_regionkey < 2").toLocalIterator():
        tables.insert_values(spark, name, row.asDict())
    seen = tables.preview(spark.table(name)).count()
    tables.drop_table(spark, name)
    rows = spark.read.schema(region.schema).parquet(path)
    return rows.withColumns({"seen": F.lit(seen).cast("long"),
                             "dropped": F.lit(not spark.catalog.tableExists(name))})
