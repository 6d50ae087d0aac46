"""Fact tables from raw messages. Frames may be bounded or unbounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import names as N
from ..functions.dates import date_text, millis_to_seconds_ts, parse_ts
from ..functions.messages import cdc_data_schema, log_schema
from ..operators import cdc
from ..operators.joins import Interval, chain_interval_joins, dictionary_join, interval_join, lookup

# Sections of the dictionary table and the "paid" status.
PAYMENT_TYPES, APPRAISALS = "11", "12"
PAID = "1602"


# --- behaviour log -------------------------------------------------------------------------

# What deciding about a line needs; the rest is parsed for accepted lines only.
_HEAD = "ts bigint, common struct<mid: string, is_new: string>"


def split_log(messages: DataFrame, *extra: str) -> tuple[DataFrame, DataFrame]:
    """(valid lines as mid, is_new, ts, value; quarantined raw lines with the processing date).

    A line is valid when it has a time and a device; malformed text has neither.
    """
    parsed = cdc.parse_once(messages, {"log": F.from_json("value", _HEAD)}, "value", *extra)
    valid = F.col("log.ts").isNotNull() & F.col("log.common.mid").isNotNull()
    good, bad = cdc.split_valid(parsed, valid)
    return (good.select(F.col("log.common.mid").alias("mid"),
                        F.col("log.common.is_new").alias("is_new"),
                        millis_to_seconds_ts("log.ts").alias("ts"), "value", *extra),
            bad.select("value", F.date_format(F.current_date(), "yyyy-MM-dd").alias("date")))


def classified_log(messages: DataFrame, *extra: str) -> DataFrame:
    """Every line with ``valid``, which tells whether ``split_log`` accepts it; for counting both
    kinds in one pass (``observe``) and for writing them apart by that column."""
    parsed = cdc.parse_once(messages, {"log": F.from_json("value", _HEAD)}, "value", *extra)
    valid = F.col("log.ts").isNotNull() & F.col("log.common.mid").isNotNull()
    return parsed.select("value", F.coalesce(valid, F.lit(False)).alias("valid"), *extra)


def open_log(accepted: DataFrame, corrected: bool = True) -> DataFrame:
    """Parse accepted lines again in full; the device flag goes into ``common``.

    ``corrected=False`` leaves the flag as the device reported it.
    """
    logs = cdc.parse_once(accepted, {"log": F.from_json("value", log_schema())}, "is_new", "ts")
    common = F.col("log.common")
    if corrected:
        common = common.withField("is_new", F.col("is_new"))
    return logs.select(common.alias("common"), "log.page", "log.start", "log.err",
                       "log.displays", "log.actions", "ts")


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", date_text("ts"))


def log_starts(logs: DataFrame) -> DataFrame:
    return _dated(logs.where(F.col("start").isNotNull()).select("common.*", "start.*", "ts"))


def log_errors(logs: DataFrame) -> DataFrame:
    return _dated(logs.where(F.col("err").isNotNull()).select("err.*", "ts"))


def log_pages(logs: DataFrame) -> DataFrame:
    return _dated(logs.where(F.col("page").isNotNull()).select("common.*", "page.*", "ts"))


def log_displays(logs: DataFrame) -> DataFrame:
    shown = logs.select("common", "page", F.explode("displays").alias("d"), "ts")
    return _dated(shown.select(
        "common.*", "page.*", "d.display_type", F.col("d.item").alias("display_item"),
        F.col("d.item_type").alias("display_item_type"), "d.pos_seq", "d.pos_id", "ts"))


def log_actions(logs: DataFrame) -> DataFrame:
    acted = logs.select("common", "page", F.explode("actions").alias("a"), "ts")
    return _dated(acted.select(
        "common.*", "page.*", "a.action_id", F.col("a.item").alias("action_item"),
        F.col("a.item_type").alias("action_item_type"), "ts"))


LOG_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    N.LOG_START: log_starts,
    N.LOG_ERR: log_errors,
    N.LOG_PAGE: log_pages,
    N.LOG_DISPLAY: log_displays,
    N.LOG_ACTION: log_actions,
}


# --- orders and payments -------------------------------------------------------------------

def order_details(messages: DataFrame, database: str | None = None, delay: str = "1 minute",
                  around: int = 10, slot_seconds: int | None = None) -> DataFrame:
    """Order lines with their order, activity and coupon, each within ``around`` seconds.

    The activity and coupon messages name only the order, so an order with several
    lines and several of these yields every combination. Narrow ``slot_seconds`` spread a
    very busy key over more tasks.
    """
    def rows(table: str) -> DataFrame:
        frame = cdc.table_rows(messages, table, cdc_data_schema(table), database=database)
        return frame.withWatermark("create_time", delay) if frame.isStreaming else frame

    def near(table: str, key: str, how: str, keep: list[str]) -> Interval:
        return Interval(rows(table), key, "create_time", -around, around, how, keep)

    wide = chain_interval_joins(rows("order_detail"), "order_id", "create_time", [
        near("order_info", "id", "inner", ["province_id"]),
        near("order_detail_activity", "order_id", "left", ["activity_id", "activity_rule_id"]),
        near("order_detail_coupon", "order_id", "left", ["coupon_id"])], slot_seconds=slot_seconds)
    return wide.withColumn("date", date_text("create_time"))


# The columns a payment takes from its order.
ORDER_COLUMNS = ["sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
                 "sku_name", "order_price", "sku_num", "split_total_amount",
                 "split_activity_amount", "split_coupon_amount"]


def paid(messages: DataFrame, database: str | None = None) -> DataFrame:
    """Updates that set a payment to paid; the callback time is the payment time."""
    rows = cdc.table_rows(messages, "payment_info", cdc_data_schema("payment_info"),
                          (N.UPDATE,), database)
    return (rows.where(F.col("payment_status") == PAID)
            .withColumnRenamed("callback_time", "payment_time").drop("payment_status"))


def payments_with_orders(payments: DataFrame, orders: DataFrame, delay: str = "1 minute",
                         within: int = 15 * 60, slot_seconds: int | None = None) -> DataFrame:
    """Payments with the lines of the order paid at most ``within`` seconds after it was placed.

    One row per order line, each repeating the paid amount; both sides carry a
    watermark so that neither side's state grows without end.
    """
    if payments.isStreaming:
        payments = payments.withWatermark("payment_time", delay)
        orders = orders.withWatermark("create_time", delay)
    joined = interval_join(payments, orders, "order_id", "order_id", "payment_time", "create_time",
                           0, within, "left", keep=ORDER_COLUMNS, slot_seconds=slot_seconds)
    return joined.drop("id")


def name_payments(joined: DataFrame, dictionary: DataFrame, users: DataFrame,
                  user_key: str = "id") -> DataFrame:
    """Payment type name and user name (empty text for an unknown user)."""
    named = dictionary_join(joined, dictionary, PAYMENT_TYPES, "payment_type", "payment_name")
    named = lookup(named, users, "user_id", user_key, {"name": "user_name"}, default="")
    return named.withColumn("date", date_text("payment_time"))


# --- carts, comments, users ----------------------------------------------------------------

def cart_adds(messages: DataFrame, database: str | None = None) -> DataFrame:
    """Cart inserts, and the growth of updates that raise the quantity.

    The table is tested for updates as well as for inserts.
    """
    candidates = cdc.envelope(messages.where(cdc.mentions("cart_info")))
    changes = cdc.of_table(candidates, "cart_info", (N.INSERT, N.UPDATE), database)
    parsed = cdc.parse_once(
        changes, {"data": F.from_json("data", cdc_data_schema("cart_info")),
                  "old": F.from_json("old", "map<string,string>")}, "type")
    grown = cdc.increases(parsed, "sku_num", "cart_price").select("data.*")
    return grown.withColumn("date", date_text("create_time"))


def comment_rows(messages: DataFrame, database: str | None = None) -> DataFrame:
    return cdc.table_rows(messages, "comment_info", cdc_data_schema("comment_info"),
                          database=database)


def name_comments(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The appraisal code becomes its dictionary name (null when unknown)."""
    named = dictionary_join(rows, dictionary, APPRAISALS, "appraise")
    return named.withColumn("date", date_text("create_time"))


def comments(messages: DataFrame, dictionary: DataFrame, database: str | None = None
             ) -> DataFrame:
    return name_comments(comment_rows(messages, database), dictionary)


def registered_users(messages: DataFrame, database: str | None = None) -> DataFrame:
    rows = cdc.table_rows(messages, "user_info", cdc_data_schema("user_info"), N.INSERT_KINDS,
                          database)
    return (rows.withColumn("create_time", parse_ts("create_time"))
            .withColumn("date", date_text("create_time")))
