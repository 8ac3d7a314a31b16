"""Column layouts, closed vocabularies and limits of the order warehouse.

Layouts are ordered ``name -> Spark SQL type`` maps; :func:`ddl` turns one into the schema string that
``spark.read.schema``, ``from_json`` and ``createDataFrame`` accept. Nothing in the library infers a schema.
"""

from __future__ import annotations

MONEY = "decimal(12,2)"
TOTAL = "decimal(15,2)"

# Event fields, in the order they are published. All are read as text, so that one bad
# number spoils its own field only.
EVENT_FIELDS = (
    "order_id", "event_timestamp", "order_timestamp",
    "customer_id", "customer_name", "customer_city", "customer_region", "customer_age", "customer_gender",
    "product_id", "product_name", "category", "brand", "unit_price",
    "store_id", "store_name", "store_type", "store_city", "store_region",
    "quantity", "total_amount", "tax_amount", "final_amount", "payment_method", "order_status",
    "is_first_order", "device_type", "source",
)
REQUIRED_FIELDS = (
    "order_id", "order_timestamp", "customer_id", "product_id", "store_id",
    "quantity", "unit_price", "final_amount", "category", "order_status",
)

CUSTOMERS = {
    "customer_id": "string", "name": "string", "email": "string", "phone": "string",
    "city": "string", "state": "string", "region": "string", "age": "int", "gender": "string",
    "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
}
PRODUCTS = {
    "product_id": "string", "name": "string", "category": "string", "brand": "string",
    "original_price": MONEY, "discounted_price": MONEY, "discount_pct": "int", "rating": "decimal(3,1)",
    "stock_quantity": "int", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
}
STORES = {
    "store_id": "string", "store_name": "string", "city": "string", "region": "string",
    "store_type": "string", "created_at": "timestamp_ntz",
}
# Master columns that are not loaded but stamped with the time of the load.
STAMPED = {"customers": ("updated_at",), "products": ("created_at", "updated_at"), "stores": ("created_at",)}
# The 26 columns an order is loaded with.
ORDER_COLUMNS = {
    "order_id": "string", "order_timestamp": "timestamp_ntz", "event_timestamp": "timestamp_ntz",
    "customer_id": "string", "product_id": "string", "store_id": "string",
    "customer_city": "string", "customer_region": "string", "customer_age": "int", "customer_gender": "string",
    "product_name": "string", "category": "string", "brand": "string",
    "store_type": "string", "store_city": "string", "store_region": "string",
    "quantity": "int", "unit_price": MONEY, "total_amount": MONEY, "tax_amount": MONEY, "final_amount": MONEY,
    "payment_method": "string", "order_status": "string",
    "is_first_order": "boolean", "device_type": "string", "source": "string",
}
DERIVED_COLUMNS = {"ingested_at": "timestamp_ntz", "revenue_per_unit": MONEY, "order_hour": "int"}
# ``ingest_batch`` names the micro-batch a row came in with; ``order_date`` is the partition column.
ORDERS = {**ORDER_COLUMNS, **DERIVED_COLUMNS, "ingest_batch": "string", "order_date": "date"}

SUMMARY_KEYS = {"summary_date": "date", "category": "string", "region": "string"}
SUMMARY_MEASURES = {
    "total_orders": "bigint", "total_revenue": TOTAL, "total_tax": TOTAL, "avg_order_value": MONEY,
    "total_quantity": "bigint", "unique_customers": "bigint", "new_customers": "bigint",
    "delivered_count": "bigint", "cancelled_count": "bigint", "returned_count": "bigint",
    "upi_count": "bigint", "card_count": "bigint", "cod_count": "bigint",
}
# ``through_seq`` is the last batch whose orders are counted for certain.
DAILY_SUMMARY = {
    "category": "string", "region": "string", **SUMMARY_MEASURES,
    "computed_at": "timestamp_ntz", "through_seq": "bigint", "summary_date": "date",
}
REJECTS = {
    **{name: "string" for name in EVENT_FIELDS},
    "payload": "string", "reject_reason": "string", "reject_reasons": "array<string>", "ingest_batch": "string",
}
BATCH_METRICS = {
    "batch_id": "bigint", "consumed": "bigint", "inserted": "bigint", "invalid": "bigint", "failed": "bigint",
    "finished_at": "timestamp_ntz", "ingest_batch": "string",
}
# ``seq`` counts the batches; it is taken after the orders of the batch are stored.
TOUCHED_DATES = {"order_date": "date", "seq": "bigint", "ingest_batch": "string"}
ORDER_KEYS = {"order_id": "string", "ingest_batch": "string", "bucket": "int"}
OPEN_BATCHES = {"order_date": "date", "ingest_batch": "string"}
# One file for each attempt at a batch that ended in an error.
FAILED_ATTEMPTS = {"failed_at": "timestamp_ntz", "error": "string", "ingest_batch": "string"}
MASTER_REJECTS = {
    "table_name": "string", "row_key": "string", "reject_reason": "string", "reject_reasons": "array<string>",
    "row_json": "string", "load_label": "string",
}

# Closed vocabularies.
CATEGORIES = ("Electronics", "Fashion", "Home & Kitchen", "Sports", "Books", "Beauty", "Toys", "Grocery")
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "EMI")
ORDER_STATUSES = ("Placed", "Confirmed", "Shipped", "Delivered", "Cancelled", "Returned")
NON_REVENUE_STATUSES = ("Cancelled", "Returned")
GENDERS = ("Male", "Female", "Other")
STORE_TYPES = ("Online", "Offline", "Hybrid")
CITY_REGIONS = {
    "Ahmedabad": "West", "Mumbai": "West", "Surat": "West", "Delhi": "North", "Jaipur": "North",
    "Lucknow": "North", "Kanpur": "North", "Bangalore": "South", "Chennai": "South", "Hyderabad": "South",
    "Kolkata": "East", "Nagpur": "Central", "Pune": "West", "Indore": "Central", "Thane": "West",
}
DEFAULT_REGION = "Central"
GST_RATE = 0.18

# Widest text each column may hold, and the columns that must look like a UUID.
TEXT_LIMITS = {
    "customers": {"name": 100, "email": 150, "phone": 20, "city": 50, "state": 50, "region": 20, "gender": 10},
    "products": {"name": 200, "category": 50, "brand": 100},
    "stores": {"store_name": 150, "city": 50, "region": 20, "store_type": 20},
    "orders": {
        "customer_city": 50, "customer_region": 20, "customer_gender": 10, "product_name": 200, "category": 50,
        "brand": 100, "store_type": 20, "store_city": 50, "store_region": 20, "payment_method": 30,
        "order_status": 20, "device_type": 20, "source": 30,
    },
}
UUID_COLUMNS = {
    "customers": ("customer_id",), "products": ("product_id",), "stores": ("store_id",),
    "orders": ("order_id", "customer_id", "product_id", "store_id"),
}


def ddl(layout: dict[str, str]) -> str:
    """Schema string of a layout."""
    return ", ".join(f"`{name}` {kind}" for name, kind in layout.items())
