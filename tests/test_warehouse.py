"""All jobs end to end on a few hand-written messages."""

import json
import os

import pytest

from rillhouse import names as N
from rillhouse.plans.jobs import Warehouse
from rillhouse.sources import readers
from rillhouse.live.run import state_partitions

TEXT = [{"name": "id", "type": "string"}, {"name": "name", "type": "string?"}]


def change(table, kind="insert", **data):
    return {"database": "shop", "table": table, "type": kind, "data": data, "ts": 1704067200}


def config(source, keyed, columns):
    declared = [{"name": c, "type": "string" if c in ("id", "dic_code") else "string?"} for c in columns]
    return change(N.CONFIG_TABLE, id=source, source_table=source, sink_table=f"dim_{source}",
                  row_key=columns[0], schema=json.dumps(declared), column_family="info",
                  to_hbase=int(keyed))


def at(time):
    return f"2024-01-01 {time}"


DB = [
    config("base_dic", False, ["dic_code", "dic_name", "parent_code"]),
    config("user_info", True, ["id", "name"]),
    config("sku_info", True, ["id", "sku_name", "spu_id", "tm_id", "category3_id"]),
    config("spu_info", True, ["id", "spu_name"]),
    config("base_category3", True, ["id", "name", "category2_id"]),
    config("base_category2", True, ["id", "name", "category1_id"]),
    config("base_category1", True, ["id", "name"]),
    config("base_trademark", True, ["id", "tm_name"]),
    config("base_province", True, ["id", "name"]),
    config("dropped", False, ["id", "name"]), change(N.CONFIG_TABLE, "delete", id="dropped",
        source_table="dropped", sink_table="d", row_key="id", schema="[]", to_hbase=0),
    change("base_dic", "bootstrap-start"),
    change("base_dic", "bootstrap-insert", dic_code="1101", dic_name="card", parent_code="11"),
    change("base_dic", "bootstrap-insert", dic_code="1201", dic_name="fine", parent_code="12"),
    change("base_dic", "update", dic_code="1201", dic_name="good", parent_code="12"),
    change("base_dic", "bootstrap-complete"),
    change("sku_info", id="s1", sku_name="pen", spu_id="p1", tm_id="t1", category3_id="c3"),
    change("spu_info", id="p1", spu_name="pens"), change("base_trademark", id="t1", tm_name="Acme"),
    change("base_category3", id="c3", name="C3", category2_id="c2"),
    change("base_category2", id="c2", name="C2", category1_id="c1"),
    change("base_category1", id="c1", name="C1"), change("base_province", id="7", name="North"),
    change("user_info", id="u1", name="Ann", create_time=at("08:00:00")),
    change("user_info", id="u2", name="Bo", create_time=at("08:00:07")),
    change("user_info", "update", id="u1", name="Anna", create_time=at("08:00:00")),
    change("user_info", id="u9", name="Zed", create_time=at("12:00:00")),
    change("order_detail", order_id="o1", sku_id="s1", sku_name="pen", sku_num=2, order_price=10.0,
           create_time=at("10:00:01")),
    change("order_info", id="o1", province_id="7", create_time=at("10:00:03")),
    change("order_detail_coupon", order_id="o1", coupon_id="k1", create_time=at("10:00:02")),
    change("order_detail", order_id="o2", sku_id="s2", sku_num=1, order_price=5.0,
           create_time=at("10:00:02")),
    change("order_info", id="o2", province_id="7", create_time=at("10:00:30")),     # too far: no order
    change("order_detail_activity", order_id="oX", activity_id="a", create_time=at("10:00:02")),
    change("payment_info", "update", id="pay1", order_id="o1", user_id="u1", payment_type="1101",
           payment_status="1602", total_amount=10.0, callback_time=at("10:05:00")),
    change("payment_info", "update", id="pay2", order_id="o1", user_id="nobody", payment_type="1999",
           payment_status="1602", total_amount=1.0, callback_time=at("10:20:00")),  # after 15 minutes
    change("payment_info", "update", id="pay3", order_id="o1", user_id="u1", payment_type="1101",
           payment_status="1601", total_amount=1.0, callback_time=at("10:06:00")),
    change("comment_info", id="cm1", user_id="u1", appraise="1201", create_time=at("11:00:00")),
    {**change("cart_info", "update", id="1", user_id="u1", sku_id="s1", cart_price=4.5, sku_num=3,
              create_time=at("09:00:01")), "old": {"sku_num": "1"}},
    change("cart_info", id="2", user_id="u1", sku_id="s2", cart_price=1.0, sku_num=1,
           create_time=at("09:00:05")),
    change("cart_info", id="3", user_id="u2", sku_id="s2", cart_price=1.0, sku_num=1,
           create_time=at("12:00:00")),
    "{broken", "",
]
LATE = "2024-01-01 23:00:00"
# One later message per stream moves its watermark past everything above.
FLUSH = [
    change("order_detail", order_id="zz", sku_id="s1", sku_num=1, order_price=1.0, create_time=LATE),
    change("order_info", id="zz", province_id="7", create_time=LATE),
    change("order_detail_activity", order_id="zz", activity_id="a", create_time=LATE),
    change("order_detail_coupon", order_id="zz", coupon_id="a", create_time=LATE),
    change("payment_info", "update", id="payY", order_id="zz", user_id="u9", payment_type="1101",
           payment_status="1602", total_amount=0.0, callback_time="2024-01-01 23:05:00"),
    change("payment_info", "update", id="payZ", order_id="none", user_id="u9", payment_type="1101",
           payment_status="1602", total_amount=0.0, callback_time=LATE),
]


def view(mid, second, page, last, uid="u1", **more):
    return {"common": {"mid": mid, "uid": uid, "is_new": "0", "ar": "7", "ch": "app", "vc": "v1"},
            "ts": 1704103200000 + second * 1000, "page": {
                "page_id": page, "last_page_id": last, "during_time": "1500", **more}}


LOG = [
    view("m1", 0, "home", None), view("m1", 3, "search", "home"),
    view("m1", 4, "list", "search", item="Red Pen", item_type="keyword"),
    view("m1", 5, "good_detail", "list"), view("m2", 6, "home", None, uid="u2"),
    {**view("m1", 6, "home", "list"), "displays": [{"item": "1"}, {"item": "2"}],
     "actions": [{"action_id": "fav", "item": "1"}]},
    {"common": {"mid": "m3"}, "ts": 1704103201000, "start": {"entry": "icon"},
     "err": {"error_code": 5}},
    {"common": {"uid": "no device"}, "ts": 1}, "nonsense",
    view("m9", 3600, "home", None, uid="u9"),
    view("m9", 3601, "list", "search", uid="u9", item="later", item_type="keyword"),
    view("m9", 3602, "good_detail", "list", uid="u9"),
]


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))

    def topic(name, parts):
        for at_, messages in enumerate(parts):
            lines = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
            spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(
                f"{root}/{name}")
        return lambda: readers.message_stream(spark, "text", f"{root}/{name}")

    return Warehouse(spark, root, topic("db", [DB, FLUSH]), topic("log", [LOG]), database="shop",
                     available_now=True)


def finish(spark, *queries):
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_all_jobs(spark, house):
    with state_partitions(spark):
        finish(spark, house.config_sync())
        assert rows(house.config().read(spark), "id")[0] == ("base_category1",)
        assert house.config().read(spark).where("id = 'dropped'").count() == 0
        finish(spark, house.dimension_sync(), house.keyed_dimension_sync())
        assert rows(house.read_dimension(N.DIM_BASE_DIC), "dic_code", "dic_name") == [
            ("1101", "card"), ("1201", "good")]
        assert rows(house.read_dimension(N.DIM_USER_INFO), "id", "name") == [
            ("u1", "Anna"), ("u2", "Bo"), ("u9", "Zed")]
        with pytest.raises(LookupError):
            house.read_dimension("dim_unknown")

        finish(spark, *house.log_split())
        dwd = lambda table: spark.read.parquet(house.path(N.DWD, table))
        assert dwd(N.LOG_INVALID).count() == 2
        assert dwd(N.LOG_PAGE).count() == 9
        assert rows(dwd(N.LOG_PAGE).where("mid = 'm1'"), "is_new")[0] == ("1",)
        assert rows(dwd(N.LOG_DISPLAY), "display_item") == [("1",), ("2",)]
        assert rows(dwd(N.LOG_ACTION), "action_id", "action_item") == [("fav", "1")]
        assert rows(dwd(N.LOG_START), "mid", "entry") == [("m3", "icon")]
        assert rows(dwd(N.LOG_ERR), "error_code") == [(5,)]

        finish(spark, house.order_details())
        wide = dwd(N.DWD_ORDER_DETAIL).where("order_id <> 'zz'")
        assert rows(wide, "order_id", "province_id", "activity_id", "coupon_id") == [
            ("o1", "7", None, "k1")]
        finish(spark, house.payments(), house.carts(), house.comments(), house.users())
        assert rows(dwd(N.DWD_PAYMENT).where("order_id = 'o1'"), "total_amount", "sku_id",
                    "payment_name", "user_name") == [
            (1.0, None, None, ""), (10.0, "s1", "card", "Anna")]
        assert rows(dwd(N.DWD_CART), "id", "sku_num", "cart_price") == [
            ("1", 2, 0.0), ("2", 1, 1.0), ("3", 1, 1.0)]
        assert rows(dwd(N.DWD_COMMENT), "id", "appraise") == [("cm1", "good")]
        assert rows(dwd(N.DWD_USER), "id") == [("u1",), ("u2",), ("u9",)]

        finish(spark, house.search_keywords(), house.page_views(salts=2),
               house.home_detail_visitors(salts=1), house.user_logins(salts=1), house.registrations(),
               house.cart_add_users(salts=1), house.payment_users(salts=1), house.sku_orders(),
               house.province_orders())
    dws = lambda table: house.metric(table).read(spark)
    assert rows(dws("dws_search_keyword_count"), "startTime", "keyword", "count") == [
        ("2024-01-01 10:00:00", "pen", 1), ("2024-01-01 10:00:00", "red", 1)]
    assert rows(dws("dws_traffic_page_view_count").where("endTime < '2024-01-01 11'"),
                "ar", "is_new", "pvCt", "uvCt", "svCt", "durSum") == [("7", "1", 6, 2, 2, 9000.0)]
    assert rows(dws("dws_traffic_home_detailPage_view_count"), "homeUvCt", "goodDetailUvCt") == [(2, 1)]
    assert rows(dws("dws_user_login"), "uuCt", "backCt") == [(2, 0)]
    assert rows(dws("dws_user_register"), "startTime", "registerCt") == [
        ("2024-01-01 07:59:55", 1), ("2024-01-01 08:00:00", 2), ("2024-01-01 08:00:05", 1)]
    assert rows(dws("dws_trade_cart_add"), "startTime", "cartAddUuCt") == [("2024-01-01 09:00:00", 1)]
    assert rows(dws("dws_trade_payment_suc"), "startTime", "payNewUserCnt", "payUuCnt") == [
        ("2024-01-01 10:05:00", 1, 1), ("2024-01-01 10:20:00", 1, 1)]
    assert rows(dws("dws_trade_sku_order"), "skuId", "skuName", "spuName", "trademarkName",
                "category1Name", "category3Name", "totalSkuNum", "totalOrderPrice") == [
        ("s1", "pen", "pens", "Acme", "C1", "C3", 2, 10.0)]
    assert rows(dws("dws_trade_province_order"), "provinceName", "totalOrderNum",
                "totalOrderPrice") == [("North", 1, 10.0)]


def test_jobs_by_table_give_the_same_metrics(spark, house, tmp_path):
    """After the jobs above: visitors by table, names by pruned reads, then the facts compacted."""
    for layer in (N.DWD, N.DIM):
        os.symlink(f"{house.root}/{layer}", f"{tmp_path}/{layer}")
    other = Warehouse(spark, str(tmp_path), house.topic_db, house.topic_log, database="shop", available_now=True)
    with state_partitions(spark):
        finish(spark, *other.page_views_by_table(), *other.home_detail_by_table(), *other.cart_add_by_table(),
               other.sku_orders(cached=False))
    for table in ("dws_traffic_page_view_count", "dws_traffic_home_detailPage_view_count", "dws_trade_cart_add",
                  "dws_trade_sku_order"):
        want, got = house.metric(table).read(spark), other.metric(table).read(spark)
        assert want.count() and rows(got, *want.columns) == rows(want, *want.columns)
    counts = {name: spark.read.parquet(house.path(N.DWD, name)).count() for name in facts_written(house)}
    house.compact_facts(settled_minutes=0)
    assert {name: spark.read.parquet(house.path(N.DWD, name)).count() for name in counts} == counts


def facts_written(house):
    return sorted(os.listdir(house.path(N.DWD, "").rstrip("/")))


def test_a_changed_name_shows_in_the_next_batch(spark, tmp_path):
    root = str(tmp_path)
    inbox = f"{root}/db"

    def send(*messages):
        spark.createDataFrame([(json.dumps(m),) for m in messages], "value string").coalesce(1).write.mode(
            "append").text(inbox)

    house = Warehouse(spark, root, lambda: readers.message_stream(spark, "text", inbox), lambda: None,
                      database="shop", available_now=True)
    send(config("base_dic", False, ["dic_code", "dic_name"]), config("user_info", True, ["id", "name"]),
         change("base_dic", dic_code="1", dic_name="one"), change("user_info", id="u", name="Ann"))
    with state_partitions(spark):
        for sync in (house.config_sync, house.dimension_sync, house.keyed_dimension_sync):
            finish(spark, sync())
    dic, users = house.dimension("dim_base_dic"), house.dimension("dim_user_info")
    assert rows(dic, "dic_name") == [("one",)] and rows(users, "name") == [("Ann",)]
    assert house.dimension("dim_base_dic") is dic                    # nothing stored since: not read again
    send(change("base_dic", "update", dic_code="1", dic_name="two"), change("user_info", "update", id="u", name="Bo"))
    with state_partitions(spark):
        finish(spark, house.dimension_sync(), house.keyed_dimension_sync())
    assert rows(house.dimension("dim_base_dic"), "dic_name") == [("two",)]
    assert rows(house.dimension("dim_user_info"), "name") == [("Bo",)]
    asked = spark.createDataFrame([("1",), ("u",), ("x",)], "k string")
    assert rows(house.dimension_for("dim_base_dic", asked, "k"), "dic_name") == [("two",)]
    assert rows(house.dimension_for("dim_user_info", asked, "k"), "name") == [("Bo",)]
