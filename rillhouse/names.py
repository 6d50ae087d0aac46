"""Layer, topic, table and column names of the warehouse.

They are part of the data contract (messages, configuration rows and metric
tables carry them), so they are stated once, as plain text.
"""

# Layers
DIM, DWD, DWS = "dim", "dwd", "dws"

# Topics
TOPIC_DB, TOPIC_LOG = "topic_db", "topic_log"

# Kinds of change a CDC message may carry
INSERT, UPDATE, DELETE = "insert", "update", "delete"
BOOTSTRAP_START = "bootstrap-start"
BOOTSTRAP_INSERT = "bootstrap-insert"
BOOTSTRAP_COMPLETE = "bootstrap-complete"
CONTROL_KINDS = (BOOTSTRAP_START, BOOTSTRAP_COMPLETE)
INSERT_KINDS = (INSERT, BOOTSTRAP_INSERT)

# Configuration table
CONFIG_TABLE = "dim_process"

# Behaviour-log fact tables
LOG_START = "topic_log_start"
LOG_ERR = "topic_log_err"
LOG_PAGE = "topic_log_page"
LOG_DISPLAY = "topic_log_display"
LOG_ACTION = "topic_log_action"
LOG_INVALID = "topic_log_invalid"

# Dimension tables
DIM_BASE_DIC = "dim_base_dic"
DIM_USER_INFO = "dim_user_info"
DIM_SKU_INFO = "dim_sku_info"
DIM_SPU_INFO = "dim_spu_info"
DIM_CATEGORY1 = "dim_base_category1"
DIM_CATEGORY2 = "dim_base_category2"
DIM_CATEGORY3 = "dim_base_category3"
DIM_TRADEMARK = "dim_base_trademark"
DIM_PROVINCE = "dim_base_province"

# Fact tables
DWD_COMMENT = "dwd_comment_info"
DWD_CART = "dwd_cart_info"
DWD_USER = "dwd_user_info"
DWD_ORDER_DETAIL = "dwd_order_detail"
DWD_PAYMENT = "dwd_payment_info"

# Metric tables and their keys (every other column is replaced by the newest value)
METRIC_KEYS = {
    "dws_search_keyword_count": ("startTime", "endTime", "date", "keyword"),
    "dws_traffic_page_view_count": ("startTime", "endTime", "date", "ar", "ch", "vc", "is_new"),
    "dws_traffic_home_detailPage_view_count": ("startTime", "endTime", "date"),
    "dws_user_login": ("startTime", "endTime", "date"),
    "dws_user_register": ("startTime", "endTime", "date"),
    "dws_trade_cart_add": ("startTime", "endTime", "date"),
    "dws_trade_payment_suc": ("startTime", "endTime", "date"),
    "dws_trade_sku_order": (
        "startTime", "endTime", "date", "skuId", "skuName", "spuId", "spuName",
        "trademarkId", "trademarkName", "category1Id", "category1Name",
        "category2Id", "category2Name", "category3Id", "category3Name"),
    "dws_trade_province_order": ("startTime", "endTime", "date", "provinceId", "provinceName"),
}
