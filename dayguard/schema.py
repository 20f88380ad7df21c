"""Column names of the feature table.

Fixed values: these names must equal the reference's exported headers, in the
reference's order (including its spelling "DINSTINCT" for feature 1).
"""

# --- fixed values (reference column names, natural order) -------------------
KEY_COLS = ["CUSTOMER_ID", "GA_SESSIONS_DATE"]

CITY_FEATURES = [
    "DINSTINCT_PREV_CITY_CNTS",
    "DISTINCT_CITY_DAILY_CNTS",
    "DISTINCT_NEW_CITY_CNTS",
    "CITY_NOT_SET_FLAG",
]
CLICK_FEATURES = [
    "DISTINCT_PREV_PRODUCTS_CLICKED_CNTS",
    "DISTINCT_PREV_PRODUCTS_TYPE1_CLICKED_CNTS",
    "DISTINCT_PREV_PRODUCTS_TYPE2_CLICKED_CNTS",
    "DISTINCT_NEW_PRODUCT_CLICKED_CNTS",
    "DISTINCT_NEW_PRODUCT_TYPE1_CLICKED_CNTS",
    "DISTINCT_NEW_PRODUCT_TYPE2_CLICKED_CNTS",
]
PURCHASE_FEATURES = [
    "DISTINCT_PREV_PRODUCTS_PURCHASED_CNT",
    "DISTINCT_PREV_PRODUCTS_TYPE1_PURCHASED_CNTS",
    "DISTINCT_PREV_PRODUCTS_TYPE2_PURCHASED_CNTS",
    "DISTINCT_NEW_PRODUCT_PURCHASED_CNTS",
    "DISTINCT_NEW_PRODUCT_TYPE1_PURCHASED_CNTS",
    "DISTINCT_NEW_PRODUCT_TYPE2_PURCHASED_CNTS",
]
BEHAVIOR_FEATURES = [
    "HAS_RESET_PASSWORD_FLAG",
    "HAS_ADD_NEW_ADDRESS_FLAG",
    "HAS_APPLIED_GIFTCARD_FLAG",
    "HAS_CHANGE_AUTOSHIP_FREQUENCY_FLAG",
    "HAS_AUTOSHIP_SHIP_NOW_FLAG",
    "HAS_ADD_PAYMENT_FLAG",
]
ORDER_FEATURES = [
    "TOTAL_NUM_ORDERS",
    "NUM_ONETIME_ORDERS",
    "DISTINCT_PRODUCT_ORDERED",
    "DISTINCT_PRODUCT_ONETIME_ORDERED",
    "ONETIME_ORDER_QUANTITY",
    "TOTAL_ORDER_QUANTITY",
    "TOTAL_ORDER_PRICE",
    "ONETIME_ORDER_PRICE",
]
HIT_FEATURES = [
    "DISTINCT_PRODUCT_HIT",
    "TOTAL_PRODUCT_HIT",
    "DISTINCT_PRODUCT_CLICKED",
    "TOTAL_PRODUCT_CLICKED",
    "TOTAL_PAGES_VIEWED",
    "DISTINCT_PAGES_VIEWED",
]
# --- end of fixed values ----------------------------------------------------

NEW_FEATURES = CITY_FEATURES + CLICK_FEATURES + PURCHASE_FEATURES + BEHAVIOR_FEATURES
BASIC_FEATURES = ORDER_FEATURES + HIT_FEATURES
FEATURES = NEW_FEATURES + BASIC_FEATURES
assert len(FEATURES) == 36
