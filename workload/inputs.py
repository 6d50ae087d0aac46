"""Stand-ins for the warehouse's inputs, derived from the given tables.

Messages are built from table rows as JSON text, so the queries run the whole path
from raw text. Expressions that both engines need are kept here as SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillhouse.sources.readers import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; zone-less timestamps become UTC instants."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


# Page log on top of an events frame (batch or stream).
PAGE_COLUMNS = {
    "mid": "CAST(user_id AS STRING)",
    "uid": "CAST(user_id AS STRING)",
    "ar": "concat('a', CAST(user_id % 4 AS STRING))",
    "ch": "event_type",
    "vc": "concat('v', CAST(event_id % 3 AS STRING))",
    "is_new": "CAST(user_id % 2 AS STRING)",
    "page_id": "CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' "
               "ELSE event_type END",
    "last_page_id": "CASE WHEN event_type = 'purchase' THEN NULL WHEN event_id % 5 = 0 THEN 'search'"
                    " ELSE event_type END",
    "item_type": "CASE WHEN event_id % 2 = 0 THEN 'keyword' ELSE 'sku' END",
    "item": "concat(event_type, ' Ring, ', props)",
    "during_time": "CAST(value AS STRING)",
}


def pages(ev: DataFrame) -> DataFrame:
    return ev.select("ts", *[F.expr(sql).alias(name) for name, sql in PAGE_COLUMNS.items()])


PAGES_SQL = ("SELECT event_id, ts, value, "
             + ", ".join(f"{sql} AS {name}" for name, sql in PAGE_COLUMNS.items()) + " FROM events")

# Arrival order: each block of twenty event ids comes in reverse.
ARRIVAL = "CAST(floor(event_id / 20) AS BIGINT) * 20 + 19 - event_id % 20"


def log_line(millis: str) -> str:
    """SQL text building one behaviour-log line; ``millis`` is the engine's epoch-millis call."""
    text = "CAST({} AS STRING)".format
    common = ("concat('\"common\":{\"ar\":\"a', " + text("user_id % 4") + ", '\",\"ch\":\"', event_type, "
              "'\",\"is_new\":\"', " + text("user_id % 2") + ", '\"', CASE WHEN event_id % 13 = 0 THEN '' "
              "ELSE concat(',\"mid\":\"', " + text("user_id") + ", '\"') END, ',\"uid\":\"', "
              + text("user_id") + ", '\",\"vc\":\"v', " + text("event_id % 3") + ", '\"}')")
    page = ("CASE WHEN event_type IN ('view', 'click', 'purchase') THEN "
            "concat(',\"page\":{\"page_id\":\"', event_type, '\",\"last_page_id\":', "
            "CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '\"home\"' END, "
            "',\"during_time\":\"', " + text("event_id % 1000") + ", '\"}') ELSE '' END")
    start = ("CASE WHEN event_type = 'signup' THEN concat(',\"start\":{\"entry\":\"icon\","
             "\"loading_time\":', " + text("event_id % 100") + ", '}') ELSE '' END")
    err = ("CASE WHEN event_type = 'error' THEN concat(',\"err\":{\"error_code\":', "
           + text("event_id % 7") + ", ',\"msg\":\"m', " + text("event_id % 3") + ", '\"}') ELSE '' END")

    def display(n: int) -> str:
        return ("concat('{\"display_type\":\"query\",\"item\":\"', " + text("event_id % 50")
                + f", '\",\"item_type\":\"sku\",\"pos_seq\":\"{n}\",\"pos_id\":\"', "
                + text("event_id % 5") + ", '\"}')")

    displays = ("CASE WHEN event_id % 4 = 3 THEN '' WHEN event_id % 4 = 0 THEN ',\"displays\":[]' "
                f"WHEN event_id % 4 = 1 THEN concat(',\"displays\":[', {display(1)}, ']') "
                f"ELSE concat(',\"displays\":[', {display(1)}, ',', {display(2)}, ']') END")
    actions = ("CASE WHEN event_id % 3 = 0 THEN concat(',\"actions\":[{\"action_id\":\"favor\","
               "\"item\":\"', " + text("event_id % 40") + ", '\",\"item_type\":\"sku\"}]') ELSE '' END")
    stamp = f"CASE WHEN event_id % 19 = 0 THEN '' ELSE concat(',\"ts\":', {text(millis)}) END"
    whole = (f"concat('{{', {common}, {page}, {start}, {err}, {displays}, {actions}, {stamp}, '}}')")
    return f"CASE WHEN event_id % 17 = 0 THEN substring({whole}, 1, 20) ELSE {whole} END"


def log_messages(ev: DataFrame, *extra: str) -> DataFrame:
    return spread(ev).select(F.lit(None).cast("string").alias("key"),
                     F.expr(log_line("unix_millis(ts)")).alias("value"), *extra)


BAD_LINE = "(event_id % 17 = 0 OR event_id % 13 = 0 OR event_id % 19 = 0)"


def cdc_messages(rows: DataFrame, source: str, kind, data: list, old=None, database: str = "shop"
                 ) -> DataFrame:
    """Change messages of one table from its rows: ``kind`` and ``data`` are columns."""
    fields = [F.lit(database).alias("database"), F.lit(source).alias("table"),
              kind.alias("type"), F.struct(*data).alias("data")]
    if old is not None:
        fields.append(old.alias("old"))
    return rows.select(F.lit(None).cast("string").alias("key"),
                       F.to_json(F.struct(*fields)).alias("value"))


def micros(ts: str):
    """Timestamp as text with all its digits (JSON writing would cut it to millis)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def order_messages(ev: DataFrame) -> DataFrame:
    """Clicks as order lines, purchases as orders, views as activities, errors as coupons."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    source = F.expr("CASE event_type WHEN 'click' THEN 'order_detail' WHEN 'purchase' THEN 'order_info' "
                    "WHEN 'view' THEN 'order_detail_activity' WHEN 'error' THEN 'order_detail_coupon' END")

    def of(kind: str, value):
        return F.when(F.col("event_type") == kind, value)   # null fields are left out of the text

    data = F.struct(
        of("purchase", user).alias("id"),
        F.when(F.col("event_type") != "purchase", user).alias("order_id"),
        of("click", event).alias("sku_id"), of("click", F.col("value")).alias("order_price"),
        of("click", F.col("event_id") % 9).alias("sku_num"),
        of("purchase", event).alias("province_id"), of("view", event).alias("activity_id"),
        of("view", F.lit("r1")).alias("activity_rule_id"), of("error", event).alias("coupon_id"),
        micros("ts").alias("create_time"))
    return ev.where(source.isNotNull()).select(
        F.lit(None).cast("string").alias("key"), F.to_json(F.struct(
            F.lit("shop").alias("database"), source.alias("table"), F.lit("insert").alias("type"),
            data.alias("data"))).alias("value"))


def payment_messages(ev: DataFrame) -> DataFrame:
    """Purchases as payment updates; every fifth is not paid."""
    user = F.col("user_id").cast("string")
    status = F.when(F.col("event_id") % 5 == 0, "1601").otherwise("1602")
    return cdc_messages(
        ev.where(F.col("event_type") == "purchase"), "payment_info", F.lit("update"),
        [F.col("event_id").cast("string").alias("id"), user.alias("order_id"), user.alias("user_id"),
         (F.col("event_id") % 25).cast("string").alias("payment_type"),
         status.alias("payment_status"), F.col("value").alias("total_amount"),
         micros("ts").alias("callback_time")])


def click_orders(ev: DataFrame) -> DataFrame:
    """Clicks in the shape of the order-detail fact table."""
    clicks = ev.where(F.col("event_type") == "click")
    none = F.lit(None).cast("string")
    return clicks.select(
        F.col("user_id").cast("string").alias("order_id"), F.col("ts").alias("create_time"),
        F.col("event_id").cast("string").alias("sku_id"), none.alias("province_id"),
        none.alias("activity_id"), none.alias("activity_rule_id"), none.alias("coupon_id"),
        none.alias("sku_name"), F.col("value").alias("order_price"),
        (F.col("event_id") % 9).cast("int").alias("sku_num"),
        F.lit(None).cast("double").alias("split_total_amount"),
        F.lit(None).cast("double").alias("split_activity_amount"),
        F.lit(None).cast("double").alias("split_coupon_amount"))


def payment_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as dictionary entries; two regions belong to another section."""
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("dic_code"), F.col("n_name").alias("dic_name"),
        F.when(F.col("n_regionkey") < 3, "11").otherwise("12").alias("parent_code"))


def known_users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as users; every third is unknown."""
    return (table(spark, sf, "customer").where(F.col("c_custkey") % 3 != 0)
            .select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")))


def cart_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as cart changes: a third inserts, the rest updates with old values.

    Some updates are of another table, shrink, lack the old quantity or hold bad text.
    """
    lines = spread(table(spark, sf, "lineitem"))
    key = F.col("l_orderkey") + F.col("l_linenumber")
    kind = F.when(key % 3 == 0, "insert").otherwise("update")
    old_qty = F.when(key % 7 == 0, "many").otherwise(
        (F.col("l_quantity").cast("bigint") - 10 + F.col("l_linenumber") * 2).cast("string"))
    old = F.when(key % 3 == 0, F.lit(None)).when(
        key % 5 == 0, F.create_map(F.lit("sku_num"), old_qty)).when(
        key % 11 == 0, F.create_map(F.lit("cart_price"), F.lit("1.5"))).otherwise(
        F.create_map(F.lit("sku_num"), old_qty, F.lit("cart_price"),
                     F.col("l_linenumber").cast("string")))
    source = F.when(key % 13 == 0, "favor_info").otherwise("cart_info")
    data = F.struct(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("sku_id"), F.col("l_extendedprice").alias("cart_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    return lines.select(F.lit(None).cast("string").alias("key"), F.to_json(F.struct(
        F.lit("shop").alias("database"), source.alias("table"), kind.alias("type"),
        data.alias("data"), old.alias("old"))).alias("value"))


def comment_messages(spark: SparkSession, sf: str) -> DataFrame:
    orders = spread(table(spark, sf, "orders"))
    return cdc_messages(
        orders, "comment_info", F.when(F.col("o_orderkey") % 10 == 0, "delete").otherwise("insert"),
        [F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("user_id"),
         F.col("o_orderpriority").alias("appraise"),
         F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time")])


def appraisal_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Order priorities as dictionary entries; one of them is in another section."""
    code = F.col("o_orderpriority")
    return (table(spark, sf, "orders").select(code.alias("dic_code")).distinct()
            .select("dic_code", F.expr("substring(dic_code, 3)").alias("dic_name"),
                    F.when(F.col("dic_code") == "5-LOW", "13").otherwise("12").alias("parent_code")))


# Kind of change per customer row.
USER_KIND = ("CASE c_custkey % 6 WHEN 0 THEN 'insert' WHEN 1 THEN 'bootstrap-insert' WHEN 2 THEN "
             "'update' WHEN 3 THEN 'delete' WHEN 4 THEN 'bootstrap-start' ELSE 'bootstrap-complete' END")


def user_messages(spark: SparkSession, sf: str, source: str = "user_info") -> DataFrame:
    customers = table(spark, sf, "customer")
    return cdc_messages(
        customers, source, F.expr(USER_KIND),
        [F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
         F.col("c_mktsegment").alias("user_level"),
         F.expr("concat('2024-01-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), ' 08:00:00')")
         .alias("create_time")])


# Changes to the customer table: (condition, key shift, kind, order, name suffix).
# No two changes of one key have the same order.
CUSTOMER_CHANGES = [
    ("c_custkey % 7 = 0", 0, "update", 1, "*u"),
    ("c_custkey % 13 = 0", 0, "insert", 2, "*again"),
    ("c_custkey % 11 = 0", 0, "delete", 3, ""),
    ("c_custkey % 22 = 0", 0, "insert", 4, "*back"),
    ("c_custkey % 21 = 0", 0, "update", 5, "*twice"),
    ("c_custkey % 50 = 0", 1_000_000, "insert", 1, "*new"),
    ("c_custkey % 100 = 0", 1_000_000, "update", 2, "*newer"),
    ("c_custkey % 97 = 0", 2_000_000, "update", 1, "*stray"),
    ("c_custkey % 89 = 0", 3_000_000, "delete", 1, ""),
]

CUSTOMER_CHANGES_SQL = " UNION ALL ".join(
    f"SELECT c_custkey + {shift} AS c_custkey, concat(c_name, '{suffix}') AS c_name, c_nationkey, "
    f"c_acctbal, c_mktsegment, '{kind}' AS type, {order} AS seq FROM customer WHERE {test}"
    for test, shift, kind, order, suffix in CUSTOMER_CHANGES)


def customer_changes(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    parts = [customer.where(test).select(
        (F.col("c_custkey") + shift).alias("c_custkey"), F.concat("c_name", F.lit(suffix)).alias("c_name"),
        "c_nationkey", "c_acctbal", "c_mktsegment", F.lit(kind).alias("type"), F.lit(order).alias("seq"))
        for test, shift, kind, order, suffix in CUSTOMER_CHANGES]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as order-detail rows for the item metrics."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("sku_id"), F.col("l_quantity").cast("int").alias("sku_num"),
        F.col("l_extendedprice").alias("order_price"), F.col("l_shipdate").alias("create_time"))


def sku_dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """part → supplier (as product and category 3) → nation → region, brand as trademark."""
    part, supplier = table(spark, sf, "part"), table(spark, sf, "supplier")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    suppliers = max(supplier.count(), 1)   # keys run from 0; one number comes to the driver
    supplied = (F.col("p_partkey") % suppliers).cast("string")
    key = F.col("s_suppkey").cast("string").alias("id")
    return {
        "dim_sku_info": part.select(
            F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("sku_name"),
            supplied.alias("spu_id"), supplied.alias("category3_id"), F.col("p_brand").alias("tm_id")),
        "dim_spu_info": supplier.select(key, F.col("s_name").alias("spu_name")),
        "dim_base_category3": supplier.select(
            key, F.concat(F.lit("c3 "), "s_name").alias("name"),
            F.col("s_nationkey").cast("string").alias("category2_id")),
        "dim_base_category2": nation.select(
            F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("string").alias("category1_id")),
        "dim_base_category1": region.select(
            F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name")),
        "dim_base_trademark": part.select(F.col("p_brand").alias("id")).distinct()
            .select("id", F.upper("id").alias("tm_name")),
    }


def province_details(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer's nation as province."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").cast("string").alias("order_id"),
                    F.col("c_nationkey").cast("string").alias("province_id"),
                    F.col("o_totalprice").alias("order_price"), F.col("o_orderdate").alias("create_time")))


def provinces(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"),
                                             F.col("n_name").alias("name"))
