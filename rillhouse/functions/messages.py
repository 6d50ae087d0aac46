"""Declared schemas of the incoming messages (fixed values, natural order)."""

from __future__ import annotations

from pyspark.sql import types as T

from .types import ROOT, SchemaFile, fields_of, struct_of

# ``data`` payload of each CDC table.
CDC_DATA: dict[str, str] = {
    "order_detail": (
        "order_id string, sku_id string?, sku_name string?, sku_num int?, order_price double?, "
        "create_time timestamp, split_total_amount double?, split_activity_amount double?, "
        "split_coupon_amount double?"),
    "order_info": "id string, province_id string?, create_time timestamp",
    "order_detail_activity": (
        "order_id string, activity_id string?, activity_rule_id string?, create_time timestamp"),
    "order_detail_coupon": "order_id string, coupon_id string?, create_time timestamp",
    "payment_info": (
        "id string, order_id string, user_id string, payment_type string?, "
        "payment_status string?, total_amount double?, callback_time timestamp"),
    "cart_info": (
        "id string?, user_id string?, sku_id string?, cart_price double?, sku_num long?, "
        "sku_name string?, is_checked string?, create_time string?, operate_time string?, "
        "is_ordered string?, order_time string?"),
    "comment_info": (
        "id string, user_id string, nick_name string, sku_id string, spu_id string, "
        "order_id string, appraise string, comment_txt string, create_time string"),
    "user_info": (
        "id string, login_name string?, name string?, phone_num string?, email string?, "
        "user_level string?, gender string?, create_time string?"),
    "dim_process": (
        "id string?, source_table string?, sink_table string?, row_key string?, "
        "schema string?, partitionBy string?, column_family string?, to_hbase int?"),
}

# Behaviour log: the root struct and the structs it names.
LOG_STRUCTS: dict[str, str] = {
    ROOT: (
        "common common_struct, page page_struct?, actions array<action_struct>?, "
        "displays array<display_struct>?, start start_struct?, err error_struct?, ts long"),
    "common_struct": (
        "ar string?, ba string?, ch string?, is_new string, md string?, mid string, os string?, "
        "sid string?, uid string?, vc string?"),
    "page_struct": (
        "time string?, item string?, item_type string?, last_page_id string?, page_id string?, "
        "from_pos_id string?, from_pos_seq string?, refer_id string?, during_time string?"),
    "action_struct": "action_id string?, item string?, item_type string?",
    "display_struct": (
        "display_type string?, item string?, item_type string?, pos_seq string?, pos_id string?"),
    "start_struct": (
        "entry string?, first_open long?, loading_time long?, open_ad_id long?, "
        "open_ad_ms long?, open_ad_skip_ms long?"),
    "error_struct": "error_code long?, msg string?",
}


def cdc_data_schema(table: str) -> T.StructType:
    return struct_of(fields_of(CDC_DATA[table]))


def log_schema() -> T.StructType:
    structs = {name: fields_of(text) for name, text in LOG_STRUCTS.items()}
    return SchemaFile("topic_log", structs).schema()
