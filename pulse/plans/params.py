"""Parameters of the registered queries (shared by the Spark side and the oracle)."""

DAY = "2024-01-15"
YESTERDAY = "2024-01-14"
NOON = "12"
KEYWORD = "RING red"
PAGE_START = 10
PAGE_LENGTH = 20
TOP_N = 10
DETAIL_ORDER = (("sku_price", "desc"), ("user_age", "asc"))
DETAIL_N = 50
DRAW = 3
