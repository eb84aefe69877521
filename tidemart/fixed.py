"""Fixed values that inputs and outputs must share with existing data."""

# Page ids of the two pages whose unique visitors are reported.
HOME_PAGE = "home"
DETAIL_PAGE = "good_detail"

# Page fields that mark a search by keyword.
KEYWORD_ITEM_TYPE = "keyword"
SEARCH_PAGE = "search"

# Change types of the row change log.
INSERT = "insert"
UPDATE = "update"
DELETE = "delete"
SNAPSHOT_INSERT = "bootstrap-insert"

# Operation letters of a change-capture envelope and the change type of each.
CHANGE_OPS = {"r": SNAPSHOT_INSERT, "c": INSERT, "u": UPDATE, "d": DELETE}

# Change types that reach a dimension table.
DIMENSION_TYPES = (SNAPSHOT_INSERT, INSERT, UPDATE)

# Order status code of a refunded order.
REFUNDED = "1005"

# Source tables of the row change log.
CART_INFO = "cart_info"
ORDER_INFO = "order_info"
ORDER_DETAIL = "order_detail"
ORDER_DETAIL_ACTIVITY = "order_detail_activity"
ORDER_DETAIL_COUPON = "order_detail_coupon"
ORDER_REFUND_INFO = "order_refund_info"
PAYMENT_INFO = "payment_info"
USER_INFO = "user_info"

# Key column of a dimension whose configuration names none.
DEFAULT_PK = "id"

# Date and date-time formats of all string columns.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
