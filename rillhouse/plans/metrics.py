"""Windowed metric tables from fact tables. Frames may be bounded or unbounded.

Window sizes and watermark delays are parameters; the defaults are the ones the
warehouse runs with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import names as N
from ..functions.dates import number, parse_ts
from ..functions.text import explode_words, tokenize
from ..live import daily
from ..operators.joins import Hop, lookup, snowflake_lookup
from ..operators.visits import first_ever, first_of_day, returned_after
from ..operators.windows import union_flagged, windowed_agg
from ..sources.tables import KeyedTable

PAGE_KEYS = ("ar", "ch", "vc", "is_new")

# Stored columns of the increments.
PAGE_VIEW_INCREMENTS = ", ".join(f"{k} string" for k in PAGE_KEYS) + (
    ", ts timestamp, pvCt bigint, svCt bigint, durSum double, uvCt bigint")
HOME_DETAIL_INCREMENTS = "ts timestamp, homeUvCt bigint, goodDetailUvCt bigint"
CART_ADD_INCREMENTS = "create_time timestamp, cartAddUuCt bigint"


def _sum(column: str, kind: str = "bigint") -> Column:
    return F.sum(column).cast(kind).alias(column)


def search_keywords(pages: DataFrame, size: str = "10 seconds", delay: str = "30 seconds",
                    split: Callable[[str | Column], Column] = tokenize) -> DataFrame:
    """Searches per word and window."""
    searched = pages.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                           & F.col("item").isNotNull()).select("item", "ts")
    words = explode_words(searched, "item", "keyword", split)
    return windowed_agg(words, "ts", size, [F.count("*").alias("count")], ["keyword"], delay=delay)


def page_views(pages: DataFrame, size: str = "10 seconds", delay: str = "3 seconds",
               keys: Sequence[str] = PAGE_KEYS, device: str = "mid", salts: int = 1) -> DataFrame:
    """Views, daily unique visitors, session starts and time spent per key and window.

    The raw rows count views, sessions and time without touching any state; only the
    visitor flag needs a key's history, and it comes from the first rows of the day.
    Both feed one windowed aggregate.
    """
    keys = list(keys)
    raw = pages.select(device, *keys, "ts", "last_page_id", "during_time")
    seconds = number("during_time")
    views = raw.select(
        *keys, "ts", F.lit(1).alias("pvCt"),
        F.col("last_page_id").isNull().cast("int").alias("svCt"), seconds.alias("durSum"))
    if views.isStreaming:
        views = views.withWatermark("ts", delay)
    first = first_of_day(raw.where(F.col(device).isNotNull()), device, "ts", keys, delay,
                         ttl_hours=24, salts=salts)
    visitors = first.select(*keys, "ts", F.lit(1).alias("uvCt"),
                            F.lit(None).cast("double").alias("durSum"))
    return windowed_agg(
        union_flagged(views, visitors), "ts", size,
        [_sum("pvCt"), _sum("uvCt"), _sum("svCt"), F.sum("durSum").alias("durSum")], keys)


def page_view_increments(batch: DataFrame, batch_id: int, store: KeyedTable,
                         keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """What one micro-batch adds to ``page_views``; visitors go on from the store's days."""
    (device,) = store.keys
    keys = list(keys)
    rows = batch.select(device, *keys, "ts", "last_page_id", "during_time").where(F.col("ts").isNotNull())
    views = rows.select(*keys, "ts", F.lit(1).alias("pvCt"),
                        F.col("last_page_id").isNull().cast("int").alias("svCt"),
                        number("during_time").alias("durSum"))
    first = daily.first_of_day_batch(rows, batch_id, store, "ts", keys)
    visitors = first.select(*keys, "ts", F.lit(1).alias("uvCt"), F.lit(None).cast("double").alias("durSum"))
    return daily.increments([views, visitors], keys, "ts")


def page_view_windows(increments: DataFrame, size: str = "10 seconds", delay: str = "3 seconds",
                      keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """Windows over ``page_view_increments``: the same rows as ``page_views``."""
    return windowed_agg(increments, "ts", size, [
        _sum("pvCt"), _sum("uvCt"), _sum("svCt"), F.sum("durSum").alias("durSum")], list(keys), delay=delay)


def home_detail_increments(batch: DataFrame, batch_id: int, store: KeyedTable, home: str = "home",
                           detail: str = "good_detail") -> DataFrame:
    """What one micro-batch adds to ``home_detail_visitors``; the store's keys are (page, device)."""
    page, device = store.keys
    seen = batch.select(page, device, "ts").where(F.col(page).isin(home, detail))
    first = daily.first_of_day_batch(seen, batch_id, store, "ts")
    flagged = first.select("ts", (F.col(page) == home).cast("int").alias("homeUvCt"),
                           (F.col(page) == detail).cast("int").alias("goodDetailUvCt"))
    return daily.increments([flagged, daily.beat(seen, "ts")], [], "ts")


def home_detail_windows(increments: DataFrame, size: str = "10 seconds", delay: str = "3 seconds"
                        ) -> DataFrame:
    return _counted(windowed_agg(increments, "ts", size, [_sum("homeUvCt"), _sum("goodDetailUvCt")],
                                 delay=delay), "homeUvCt", "goodDetailUvCt")


def cart_add_increments(batch: DataFrame, batch_id: int, store: KeyedTable) -> DataFrame:
    """What one micro-batch adds to ``cart_add_users``."""
    rows = batch.select("user_id", parse_ts("create_time").alias("create_time")).na.drop()
    first = daily.first_of_day_batch(rows, batch_id, store, "create_time")
    return daily.increments([first.select("create_time", F.lit(1).alias("cartAddUuCt")),
                             daily.beat(rows, "create_time")], [], "create_time")


def cart_add_windows(increments: DataFrame, size: str = "10 seconds", delay: str = "5 seconds"
                     ) -> DataFrame:
    return _counted(windowed_agg(increments, "create_time", size, [_sum("cartAddUuCt")], delay=delay),
                    "cartAddUuCt")


def _counted(windows: DataFrame, *counts: str) -> DataFrame:
    """Windows with something in them; beats alone make none."""
    return windows.where(F.greatest(*[F.col(c) for c in (*counts, counts[0])]) > 0)


def home_detail_visitors(pages: DataFrame, size: str = "10 seconds", delay: str = "3 seconds",
                         home: str = "home", detail: str = "good_detail", device: str = "mid",
                         page: str = "page_id", salts: int = 1) -> DataFrame:
    """Daily unique visitors of the home and the detail page.

    Each page has its own memory of a device, so the state key is (page, device).
    """
    seen = pages.select(page, device, "ts").where(F.col(page).isin(home, detail))
    first = first_of_day(seen, [page, device], "ts", delay=delay, ttl_hours=24, salts=salts)
    flagged = first.select("ts", (F.col(page) == home).cast("int").alias("homeUvCt"),
                           (F.col(page) == detail).cast("int").alias("goodDetailUvCt"))
    return windowed_agg(flagged, "ts", size, [_sum("homeUvCt"), _sum("goodDetailUvCt")])


def user_logins(pages: DataFrame, size: str = "10 seconds", delay: str = "3 seconds",
                away_days: int = 7, salts: int = 1) -> DataFrame:
    """Daily unique logins, and those back after more than ``away_days`` days."""
    logins = pages.where(
        F.col("uid").isNotNull() & F.col("ts").isNotNull()
        & (F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")))
    return returning_users(logins.select("uid", "ts"), "uid", size, delay, away_days, salts)


def returning_users(rows: DataFrame, user: str, size: str, delay: str, away_days: int = 7,
                    salts: int = 1) -> DataFrame:
    first = first_of_day(rows, user, "ts", delay=delay, salts=salts)
    flagged = first.select("ts", F.lit(1).alias("uuCt"), returned_after(away_days).alias("backCt"))
    return windowed_agg(flagged, "ts", size, [_sum("uuCt"), _sum("backCt")])


def registrations(users: DataFrame, size: str = "10 seconds", slide: str = "5 seconds",
                  delay: str = "3 seconds") -> DataFrame:
    return windowed_agg(users.select("id", "create_time"), "create_time", size,
                        [F.count("id").alias("registerCt")], slide=slide, delay=delay)


def cart_add_users(carts: DataFrame, size: str = "10 seconds", delay: str = "5 seconds",
                   salts: int = 1) -> DataFrame:
    """Users whose first cart add of the day falls into the window."""
    rows = (carts.select("user_id", "create_time")
            .where(F.col("user_id").isNotNull() & F.col("create_time").isNotNull())
            .withColumn("create_time", parse_ts("create_time"))
            .where(F.col("create_time").isNotNull()))
    first = first_of_day(rows, "user_id", "create_time", delay=delay, salts=salts)
    return windowed_agg(first, "create_time", size, [F.count("user_id").alias("cartAddUuCt")])


def payment_users(payments: DataFrame, size: str = "10 seconds", delay: str = "5 seconds",
                  salts: int = 1) -> DataFrame:
    """Users paying for the first time ever, and for the first time of the day."""
    rows = payments.select("user_id", "payment_time").na.drop(subset=["user_id", "payment_time"])
    first = first_of_day(rows, "user_id", "payment_time", delay=delay, salts=salts)
    flagged = first.select("payment_time", first_ever().alias("payNewUserCnt"),
                           F.lit(1).alias("payUuCnt"))
    return windowed_agg(flagged, "payment_time", size, [_sum("payNewUserCnt"), _sum("payUuCnt")])


def sku_orders(details: DataFrame, size: str = "5 seconds", delay: str = "1 seconds") -> DataFrame:
    """Quantity and price per item and window; the date is that of the window end."""
    rows = (details.select("sku_id", "sku_num", "order_price", "create_time")
            .na.drop(subset=["sku_id", "create_time"]))
    return windowed_agg(
        rows, "create_time", size,
        [F.sum("sku_num").cast("bigint").alias("totalSkuNum"),
         F.sum("order_price").alias("totalOrderPrice")],
        ["sku_id"], delay=delay, date_from="end")


# Which dimension gives which columns, in the order they depend on each other.
SKU_HOPS = (
    (N.DIM_SKU_INFO, "sku_id", {"sku_name": "skuName", "spu_id": "spuId", "tm_id": "trademarkId",
                                "category3_id": "category3Id"}),
    (N.DIM_SPU_INFO, "spuId", {"spu_name": "spuName"}),
    (N.DIM_CATEGORY3, "category3Id", {"name": "category3Name", "category2_id": "category2Id"}),
    (N.DIM_CATEGORY2, "category2Id", {"name": "category2Name", "category1_id": "category1Id"}),
    (N.DIM_CATEGORY1, "category1Id", {"name": "category1Name"}),
    (N.DIM_TRADEMARK, "trademarkId", {"tm_name": "trademarkName"}),
)


def name_sku_orders(metrics: DataFrame, dims: dict[str, DataFrame] | Callable[..., DataFrame],
                    key: str = "id") -> DataFrame:
    """Names along item → product, categories 3 → 2 → 1, trademark.

    ``dims`` holds the dimensions, or reads one: called with its name, the rows named so far
    and the column that holds its key, so that only the rows asked for need be read.

    Runs on closed windows, after the aggregation, so the lookups see one row per
    item and window instead of one per order line.
    """
    read = dims if callable(dims) else lambda table, rows, on: dims[table]
    named = snowflake_lookup(metrics, [Hop(partial(read, t, on=on), on, key, take)
                                       for t, on, take in SKU_HOPS])
    named = named.withColumnRenamed("sku_id", "skuId")
    return named.select(*N.METRIC_KEYS["dws_trade_sku_order"], "totalSkuNum", "totalOrderPrice")


def province_orders(details: DataFrame, size: str = "10 seconds", delay: str = "1 seconds",
                    exact: bool = False) -> DataFrame:
    """Orders (approximate distinct count unless ``exact``, batch only) and price per province."""
    rows = (details.select("order_id", "province_id", "order_price", "create_time")
            .na.drop(subset=["province_id", "order_id", "create_time"]))
    orders = F.count_distinct("order_id") if exact else F.approx_count_distinct("order_id")
    return windowed_agg(
        rows, "create_time", size,
        [orders.alias("totalOrderNum"), F.sum("order_price").alias("totalOrderPrice")],
        ["province_id"], delay=delay, date_from="end")


def name_province_orders(metrics: DataFrame, provinces: DataFrame, key: str = "id") -> DataFrame:
    named = lookup(metrics, provinces, "province_id", key, {"name": "provinceName"})
    return (named.withColumnRenamed("province_id", "provinceId")
            .select(*N.METRIC_KEYS["dws_trade_province_order"], "totalOrderNum", "totalOrderPrice"))
