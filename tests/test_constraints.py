import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderloom.operators import constraints, enrich
from orderloom.sinks.warehouse import Warehouse, insert_if_absent
from orderloom.session import shared_folder


def reasons(df, rules):
    return [r["reject_reasons"] for r in constraints.tag_violations(df, rules).collect()]


def test_master_rules(spark):
    customers = spark.createDataFrame(
        [("c1", "A", 30, "Male"), ("c2", None, 130, "X"), ("c3", "B", None, None)],
        "customer_id string, name string, age int, gender string")
    assert reasons(customers, constraints.customer_rules()) == [[], ["null_name", "bad_age", "bad_gender"], []]
    products = spark.sql("select 'p' as product_id, 'n' as name, null as category, -1.0 as original_price, "
                         "1.0 as discounted_price, 101 as discount_pct, 0.9 as rating")
    assert reasons(products, constraints.product_rules()) == [
        ["null_category", "negative_original_price", "bad_discount_pct", "bad_rating"]]
    stores = spark.sql("select 's' as store_id, 'n' as store_name, 'Kiosk' as store_type")
    assert reasons(stores, constraints.store_rules()) == [["bad_store_type"]]


def test_formats(spark):
    stores = spark.sql("select '123e4567-e89b-12d3-a456-426614174000' as store_id, repeat('x', 151) as store_name, "
                       "null as city, 'West' as region, 'Online' as store_type "
                       "union all select 'nope', 'n', 'c', 'r', 't'")
    assert reasons(stores, constraints.format_rules("stores")) == [["long_store_name"], ["malformed_store_id"]]


def test_orphans(spark):
    orders = spark.createDataFrame([("o1", "c1", "p1"), ("o2", "c9", "p9"), ("o3", None, "p1"), ("o4", "c9", "p1")],
                                   "order_id string, customer_id string, product_id string")
    dimensions = {"customers": spark.createDataFrame([("c1",)], "customer_id string"),
                  "products": spark.createDataFrame([("p1",)], "product_id string")}
    tagged = constraints.tag_orphans(orders, {
        name: constraints.orphan_keys(orders, name, dimension) for name, dimension in dimensions.items()})
    repeated = {name: dimension.union(dimension) for name, dimension in dimensions.items()}
    for found in (tagged, constraints.tag_unmatched(orders, repeated)):
        assert sorted((r["order_id"], r["reject_reasons"]) for r in found.collect()) == [
            ("o1", []), ("o2", ["orphan_customer", "orphan_product"]), ("o3", []), ("o4", ["orphan_customer"])]
        assert found.columns == [*orders.columns, "reject_reasons"]


def test_repeated_emails(spark):
    customers = spark.createDataFrame([("c1", "a", 1), ("c2", "a", 2), ("c3", None, 3), ("c4", None, 4)],
                                      "customer_id string, email string, seq int")
    tagged = constraints.tag_repeated_emails(customers, ["seq"])
    accepted, rejected = constraints.split(tagged)
    assert {r["customer_id"] for r in accepted.collect()} == {"c1", "c3", "c4"}
    assert rejected.first()["reject_reasons"] == ["duplicate_email"]


def test_defaults(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    row = constraints.with_defaults(spark.sql("select 'p' as product_id, cast(null as int) as stock_quantity"),
                                    "products", now).first()
    assert row["stock_quantity"] == 0 and row["created_at"] == dt.datetime(2024, 1, 1)
    order = constraints.with_defaults(spark.sql("select 'o' as order_id"), "orders", now).first()
    assert order["tax_amount"] == Decimal("0.00") and order["is_first_order"] is False


def test_pricing_agrees_with_float_arithmetic(spark):
    prices = [(cents / 100, quantity) for cents in range(1, 4000, 7) for quantity in (1, 3, 5)]
    df = spark.createDataFrame([(Decimal(str(p)), q) for p, q in prices], "unit_price decimal(12,2), quantity int")
    for (price, quantity), row in zip(prices, enrich.price_orders(df).collect()):
        total = round(price * quantity, 2)
        tax = round(total * 0.18, 2)
        assert [float(row[n]) for n in ("total_amount", "tax_amount", "final_amount")] == [
            total, tax, round(total + tax, 2)]


def test_discounts_agree_with_float_arithmetic(spark):
    cases = [(cents / 100, pct) for cents in range(1, 9000, 13) for pct in (0, 5, 10, 15, 20, 25, 30, 40)]
    df = spark.createDataFrame([(Decimal(str(p)), d) for p, d in cases], "original_price decimal(12,2), discount_pct int")
    got = [float(r["discounted_price"]) for r in enrich.discount_prices(df).collect()]
    assert got == [round(p * (1 - d / 100), 2) for p, d in cases]


def test_region_of_a_city(spark):
    df = spark.createDataFrame([("Pune",), ("Atlantis",), (None,)], "city string")
    assert [r["region"] for r in enrich.add_region(df).collect()] == ["West", "Central", "Central"]


def test_insert_if_absent_keeps_the_first_row(spark):
    warehouse = Warehouse(spark, shared_folder(spark, "t")).create()
    first = spark.createDataFrame([("s1", "old", 2), ("s1", "older", 1), ("s2", "two", 3)],
                                  "store_id string, store_name string, seq int")
    second = spark.createDataFrame([("s1", "new", 1), ("s3", "three", 2)], first.schema).withColumn(
        "created_at", F.lit("2001-01-01 00:00:00").cast("timestamp_ntz"))
    assert insert_if_absent(warehouse, "stores", first, "store_id", ["seq"]) == 2
    assert insert_if_absent(warehouse, "stores", second, "store_id", ["seq"]) == 1
    assert insert_if_absent(warehouse, "stores", second, "store_id", ["seq"]) == 0
    assert {(r["store_id"], r["store_name"]) for r in warehouse.read("stores").collect()} == {
        ("s1", "older"), ("s2", "two"), ("s3", "three")}
    assert warehouse.read("stores").filter("created_at > timestamp_ntz '2020-01-01 00:00:00'").count() == 3


def test_products_get_their_defaults(spark):
    warehouse = Warehouse(spark, shared_folder(spark, "t")).create()
    insert_if_absent(warehouse, "products", spark.sql("select 'p1' as product_id, 1 as seq"), "product_id", ["seq"])
    row = warehouse.read("products").first()
    assert row["stock_quantity"] == 0 and row["created_at"] is not None and row["name"] is None
