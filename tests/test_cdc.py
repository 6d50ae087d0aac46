import json

from pyspark.sql import functions as F

from rillhouse.operators import cdc
from rillhouse.plans import facts


def lines(spark, *messages):
    texts = [m if isinstance(m, str) or m is None else json.dumps(m) for m in messages]
    return spark.createDataFrame([(None, t) for t in texts], "key string, value string")


def cart(kind, num, old=None, table="cart_info", price=10.7, **more):
    message = {"database": "shop", "table": table, "type": kind,
               "data": {"id": "1", "user_id": "u", "sku_id": "s", "cart_price": price, "sku_num": num,
                        "create_time": "2024-01-01 10:00:00", **more}}
    return {**message, "old": old} if old is not None else message


def test_cart_inserts_and_growing_updates(spark):
    rows = facts.cart_adds(lines(
        spark,
        cart("insert", 3),
        cart("update", 5, {"sku_num": "2"}),                          # price not in the change: 0
        cart("update", 5, {"sku_num": "2", "cart_price": "10.2"}),    # no truncation of prices
        cart("update", 2, {"sku_num": "5"}),                          # shrinks
        cart("update", 2, {"cart_price": "1"}),                       # quantity unchanged
        cart("update", 9, {"sku_num": "many"}),                       # bad text must not fail the job
        cart("update", 9),                                            # no old values
        cart("update", 9, {"sku_num": "1"}, table="favor_info"),      # another table
        cart("delete", 9), "{broken", None)).select("cart_price", "sku_num", "date").collect()
    got = sorted((round(r.cart_price, 6), r.sku_num, r.date) for r in rows)
    assert got == [(0.0, 3, "2024-01-01"), (0.5, 3, "2024-01-01"), (10.7, 3, "2024-01-01")]


def test_database_filter(spark):
    other = {**cart("insert", 1), "database": "elsewhere"}
    messages = lines(spark, cart("insert", 1), other)
    assert facts.cart_adds(messages, "shop").count() == 1
    assert facts.cart_adds(messages).count() == 2


def test_comment_dictionary_unknown_code_is_null(spark):
    def comment(code):
        return {"database": "shop", "table": "comment_info", "type": "insert",
                "data": {"id": code, "appraise": code, "create_time": "2024-02-03 00:00:01"}}

    dictionary = spark.createDataFrame(
        [("1201", "good", "12"), ("1202", "bad", "11")], "dic_code string, dic_name string, parent_code string")
    got = facts.comments(lines(spark, comment("1201"), comment("1202"), comment(None)), dictionary)
    assert sorted(((r.id or ""), r.appraise) for r in got.collect()) == [
        ("", None), ("1201", "good"), ("1202", None)]


def test_split_valid_loses_no_row(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    good, bad = cdc.split_valid(df, F.col("x") > 0)
    assert [r.x for r in good.collect()] == [1]
    assert sorted([r.x for r in bad.collect()], key=str) == [-1, None]


def test_log_split_and_tables(spark):
    common = {"mid": "m1", "is_new": "1", "ar": "1"}
    good = {"common": common, "ts": 1704067201999, "page": {"page_id": "home"},
            "displays": [], "actions": [{"action_id": "a", "item": "7", "item_type": "sku"}]}
    start = {"common": common, "ts": 1704067202000, "start": {"entry": "icon"},
             "err": {"error_code": 3, "msg": "x"}}
    messages = lines(spark, good, start, {**good, "common": {"is_new": "0"}},
                     {k: v for k, v in good.items() if k != "ts"}, "{", None, "not json")
    valid, invalid = facts.split_log(messages)
    assert valid.count() == 2 and invalid.count() == 5
    assert valid.where("ts = timestamp'2024-01-01 00:00:01'").count() == 1   # cut to the second
    logs = facts.open_log(valid.withColumn("is_new", F.lit("0")))
    assert facts.log_pages(logs).select("is_new", "page_id", "date").collect() == [
        ("0", "home", "2024-01-01")]
    assert facts.log_pages(facts.open_log(valid.withColumn("is_new", F.lit("0")), corrected=False)
                           ).first().is_new == "1"
    assert facts.log_displays(logs).count() == 0
    assert facts.log_actions(logs).first().action_item == "7"
    assert facts.log_starts(logs).first().entry == "icon"
    assert facts.log_errors(logs).columns == ["error_code", "msg", "ts", "date"]


def test_latest_per_key_prefers_newest_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), (None, 1, "z")], "k string, seq int, v string")
    got = {r.k: (r.seq, r.v) for r in cdc.latest_per_key(df, ["k"], ["seq"]).collect()}
    assert got == {"a": (3, None), None: (1, "z")}


def test_escaped_table_name_is_found(spark):
    text = json.dumps(cart("insert", 3)).replace('"cart_info"', '"cart\\u005finfo"')
    assert facts.cart_adds(lines(spark, text)).count() == 1


def test_text_is_parsed_once(spark):
    messages = lines(spark, cart("insert", 3))
    plan = facts.cart_adds(messages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("json_tuple(") == 1
    assert plan.count("from_json(") == 2     # the payload and the old values
