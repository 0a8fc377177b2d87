"""Codes, labels, schemas and durations that the data contracts prescribe.

They are data, not logic: a different value would give a different (wrong) result.
"""

# All names below.

# Text formats --------------------------------------------------------------------------------
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH_FORMAT = "yyyyMM"

# Retail orders -------------------------------------------------------------------------------
BILLED_STATUSES = ("COMPLETE", "CLOSED")

ORDERS_SCHEMA = "order_id INT, order_date DATE, order_customer_id INT, order_status STRING"
ORDER_ITEMS_SCHEMA = (
    "order_item_id INT, order_item_order_id INT, order_item_product_id INT, "
    "order_item_quantity INT, order_item_subtotal FLOAT, order_item_product_price FLOAT"
)
DAILY_REVENUE_SCHEMA = "order_date DATE, order_revenue FLOAT"

# Type-2 dimension ----------------------------------------------------------------------------
OPEN_END = "9999-12-31 23:59:59"
HASH_SEPARATOR = "_"
HASH_COLUMN = "hash_md5"

# Trip messages -------------------------------------------------------------------------------
TRIP_SCHEMA = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
    "passenger_count INT, trip_distance FLOAT, pickup_longitude FLOAT, pickup_latitude FLOAT, "
    "RatecodeID INT, store_and_fwd_flag STRING, dropoff_longitude FLOAT, dropoff_latitude FLOAT, "
    "payment_type INT, fare_amount FLOAT, extra FLOAT, mta_tax FLOAT, tip_amount FLOAT, "
    "tolls_amount FLOAT, improvement_surcharge FLOAT, total_amount FLOAT, eventTime TIMESTAMP"
)
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided tip",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
AVERAGE_SPEED_MPH = 30

# Store sale messages -------------------------------------------------------------------------
STORE_SALE_SCHEMA = (
    "Store_id STRING, Store_location STRING, Product_id STRING, Product_category STRING, "
    "number_of_pieces_sold INT, buy_rate INT, sell_price INT, eventTime STRING"
)
SHORT_GAP_STORE = "STR_5"
SHORT_GAP = "20 seconds"
LONG_GAP = "2 minutes"

# Publishing ----------------------------------------------------------------------------------
CHUNK_SIZE = 1000
LARGE_CHUNK_SIZE = 3000
