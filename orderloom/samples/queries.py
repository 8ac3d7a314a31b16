"""Registered queries: each binds library functions to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderloom.functions import display
from orderloom.operators import clean, constraints, enrich
from orderloom.operators.absent import absent_rows
from orderloom.operators.firsts import keep_first, repeated_keys, tag_first
from orderloom.plans import quality, reports, rollup
from orderloom.plans.hourly import run_hourly
from orderloom.samples import streams, tables as given
from orderloom.schemas import MONEY, ORDER_COLUMNS, SUMMARY_KEYS, SUMMARY_MEASURES
from orderloom.session import shared_folder
from orderloom.sinks.generations import fold_batches
from orderloom.sinks.publish import publish_rows
from orderloom.sinks.warehouse import Warehouse, insert_if_absent
from orderloom.sources.adhoc import fetch
from orderloom.sources.events import decode, landed_orders
from orderloom.streaming.ingest import drain, ingest_totals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as bigints, the types the SQL check returns."""
    kinds = {T.DecimalType: "double", T.IntegerType: "bigint"}
    return df.select(*(
        F.col(f"`{field.name}`").cast(kinds[type(field.dataType)]).alias(field.name)
        if type(field.dataType) in kinds else F.col(f"`{field.name}`") for field in df.schema.fields))


# Reports over the stored orders.


@register
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.kpi_totals(
        given.order_facts(spark, sf_dir, "order_status", "final_amount", "customer_id")))


@register
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.order_facts(spark, sf_dir, "order_timestamp", "order_status", "category", "quantity",
                               "final_amount")
    return plain(reports.revenue_by_category(orders, given.AS_OF))


@register
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.order_facts(spark, sf_dir, "order_timestamp", "customer_region", "customer_id", "final_amount")
    return plain(reports.revenue_by_region(orders, given.AS_OF))


@register
def daily_revenue_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.daily_revenue_trend(
        given.order_facts(spark, sf_dir, "order_timestamp", "final_amount"), given.AS_OF))


@register
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.top_products(given.order_facts(
        spark, sf_dir, "order_status", "product_name", "category", "brand", "quantity", "final_amount")))


@register
def payment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.payment_distribution(given.order_facts(spark, sf_dir, "payment_method")))


@register
def payment_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.payment_display(given.order_facts(spark, sf_dir, "payment_method")))


@register
def hourly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.hourly_orders(given.event_orders(spark, sf_dir), given.EVENTS_DAY))


_SUMMARY_INPUT = ("order_timestamp", "category", "customer_region", "final_amount", "tax_amount", "quantity",
                  "customer_id", "is_first_order", "order_status", "payment_method")


@register
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rollup.daily_summary(given.order_facts(spark, sf_dir, *_SUMMARY_INPUT), **given.PAYMENTS))


@register
def daily_summary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = rollup.daily_summary(given.order_facts(spark, sf_dir, *_SUMMARY_INPUT), **given.PAYMENTS)
    return plain(rollup.summary_check(summary, "2001-08-01"))


@register
def daily_summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll up every day of the orders shipped early, then again the days that later shipments belong to."""
    root = shared_folder(spark, "rollup")
    facts = given.order_facts(spark, sf_dir, "event_timestamp", "july_time", *_SUMMARY_INPUT).withColumn(
        "order_timestamp", F.col("july_time"))
    early = facts.filter(F.col("event_timestamp") < F.lit("1999-01-01").cast("timestamp_ntz"))
    late = facts.filter(F.col("event_timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    warehouse = Warehouse(spark, root).create()
    for rows, seen in ((early, early), (late, facts)):
        touched = rows.select(F.to_date("order_timestamp").alias("order_date")).distinct()
        rollup.upsert_daily_summary(seen, warehouse.path("daily_summary"), touched, **given.PAYMENTS)
    return plain(warehouse.read("daily_summary").select(*SUMMARY_KEYS, *SUMMARY_MEASURES))


@register
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.recent_orders(given.order_facts(spark, sf_dir, *reports.RECENT_COLUMNS), 20))


@register
def recent_orders_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_orders_display(given.order_facts(spark, sf_dir, *reports.RECENT_COLUMNS), 15)


@register
def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("o_totalprice").cast(MONEY)
    return given.table(spark, sf_dir, "orders").select(
        "o_orderkey", display.format_currency(amount / 100).alias("small"),
        display.format_currency(amount).alias("middle"), display.format_currency(amount * 1000).alias("large"),
        display.format_number(F.col("o_orderkey")).alias("number"),
        display.format_number(F.col("o_orderkey") * 50).alias("large_number"),
        display.format_amount(amount).alias("amount"), display.format_time(F.col("o_orderdate")).alias("time"),
        display.short_id(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"))).alias("id"),
        display.short_label(F.col("o_orderpriority"), 5).alias("label"))


@register
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fetch(
        spark,
        "select order_status, count(*) as orders, sum(final_amount) as revenue from {orders} "
        "where payment_method = :method group by order_status",
        {"method": "1-URGENT"},
        orders=given.order_facts(spark, sf_dir, "order_status", "payment_method", "final_amount")))


@register
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [reports.row_count(given.table(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
              for name in ("customer", "part", "supplier", "orders", "lineitem")]
    combined = counts[0]
    for count in counts[1:]:
        combined = combined.unionByName(count)
    return combined


# Quality.


@register
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.order_facts(spark, sf_dir, "order_id", "final_amount", "order_timestamp", "order_status")
    return quality.run_dq(orders, given.AS_OF)


@register
def dq_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_dq(given.event_orders(spark, sf_dir), "2024-01-28 18:00:00")


# First copies and cleaning.


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order_id = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return given.table(spark, sf_dir, "lineitem").withColumn("order_id", order_id)


_LINE = ("order_id", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@register
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("order_id", *given.ARRIVAL)
    return keep_first(rows, ["order_id"], given.ARRIVAL).select(*_LINE)


@register
def dedup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("order_id", *given.ARRIVAL)
    return tag_first(rows, ["order_id"], given.ARRIVAL).filter("not is_first").select(*_LINE)


@register
def repeated_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(_lines(spark, sf_dir), ["order_id"])


@register
def clean_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = clean.transform(given.raw_events(spark, sf_dir, first="is_first"), given.ARRIVAL, given.CATEGORIES,
                               first="is_first")
    return plain(valid.drop("ingested_at"))


def _reasons(rejects: DataFrame) -> DataFrame:
    return rejects.select("order_id", "customer_id", "product_id", "store_id", "quantity", "final_amount",
                          "category", "reject_reason", F.array_join("reject_reasons", ",").alias("reject_reasons"))


@register
def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = clean.transform(given.raw_events(spark, sf_dir, first="is_first"), given.ARRIVAL, given.CATEGORIES,
                               first="is_first")
    return _reasons(rejects)


@register
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning with the table constraints on orders added to the business rules."""
    _, rejects = clean.transform(given.raw_events(spark, sf_dir, first="is_first"), given.ARRIVAL, given.CATEGORIES,
                                 constraints.order_rules(), first="is_first")
    return _reasons(rejects)


@register
def sink_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = given.order_facts(spark, sf_dir, "order_id", "customer_id", "quantity", "final_amount", "order_status")
    return plain(clean.sink_columns(facts))


# Constraints.


@register
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    masters = {
        "customers": (given.customer_master, "customer_id", constraints.customer_rules()),
        "products": (given.product_master, "product_id", constraints.product_rules()),
        "stores": (given.store_master, "store_id", constraints.store_rules()),
    }
    combined = None
    for name, (rows, key, rules) in masters.items():
        _, rejected = constraints.split(constraints.tag_violations(rows(spark, sf_dir), rules))
        found = rejected.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"),
                                F.array_join("reject_reasons", ",").alias("reject_reasons"))
        combined = found if combined is None else combined.unionByName(found)
    return combined


@register
def format_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = constraints.tag_violations(given.customer_master(spark, sf_dir).withColumn("phone", F.col("name"))
                                        .withColumn("state", F.concat("city", "region")),
                                        constraints.format_rules("customers"))
    return (tagged.select(F.explode("reject_reasons").alias("reason"))
            .groupBy("reason").agg(F.count("*").alias("rows")))


@register
def duplicate_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = constraints.tag_repeated_emails(given.customer_master(spark, sf_dir), ["arrival"])
    return tagged.filter(F.size("reject_reasons") > 0).select("customer_id", "email")


@register
def orphan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.order_facts(spark, sf_dir, "order_id", "customer_id", "product_id", "store_id", "final_amount")
    keys = {name: F.col(name).cast("string") for name in ("customer_id", "product_id", "store_id")}
    orders = orders.withColumns(keys)
    dimensions = {"customers": streams.accepted_customers(spark, sf_dir),
                  "products": streams.accepted_products(spark, sf_dir),
                  "stores": streams.accepted_stores(spark, sf_dir)}
    tagged = constraints.tag_unmatched(orders, dimensions)
    return plain(tagged.filter(F.size("reject_reasons") > 0).withColumn(
        "reject_reasons", F.array_join("reject_reasons", ",")))


@register
def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given.product_master(spark, sf_dir).select(
        "product_id", F.when(F.col("discount_pct") > 50, F.col("discount_pct")).alias("stock_quantity"))
    return plain(constraints.with_defaults(rows, "products", F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")))


# Loads.


@register
def insert_if_absent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not among those shipped before 1998."""
    rows = _lines(spark, sf_dir).select("order_id", *given.ARRIVAL)
    stored = rows.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return absent_rows(keep_first(rows, ["order_id"], given.ARRIVAL), stored, ["order_id"]).select(*_LINE)


@register
def master_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the customers of one region, then all of them with other values: what was there first stays."""
    warehouse = Warehouse(spark, shared_folder(spark, "masters")).create()
    customers = given.customer_master(spark, sf_dir)
    first = customers.filter("region = 'ASIA'")
    insert_if_absent(warehouse, "customers", first, "customer_id", ["arrival"])
    insert_if_absent(warehouse, "customers", customers.withColumn("state", F.lit("second")), "customer_id",
                     ["arrival"])
    return plain(warehouse.read("customers").select("customer_id", "name", "email", "city", "region", "state", "age"))


# Enrichment.


@register
def denormalize_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = given.order_facts(spark, sf_dir, "order_id", "customer_id", "product_id", "store_id", "quantity",
                              "order_timestamp", "final_amount")
    keys = {name: F.col(name).cast("string") for name in ("customer_id", "product_id", "store_id")}
    return plain(enrich.denormalize_orders(
        facts.withColumns(keys), given.customer_master(spark, sf_dir), given.product_master(spark, sf_dir),
        given.store_master(spark, sf_dir)))


@register
def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of all customers' cities, from a list that leaves out the cities of one region."""
    cities = (given.table(spark, sf_dir, "nation")
              .join(given.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
              .filter("r_name <> 'EUROPE'")
              .select(F.col("n_name").alias("city"), F.col("r_name").alias("region")))
    customers = given.customer_master(spark, sf_dir).select("customer_id", "city")
    return enrich.add_region(customers, "city", cities)


@register
def price_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(enrich.price_orders(
        given.order_facts(spark, sf_dir, "order_id", "product_id", "store_id", "unit_price", "quantity",
                          "event_timestamp")))


@register
def discount_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(enrich.discount_prices(given.product_master(spark, sf_dir)
                                        .select("product_id", "original_price", "discount_pct")))


# Messages and streams.


@register
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = given.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return decode(messages, ["k"]).select("event_id", F.col("k").try_cast("bigint").alias("k"), "payload")


@register
def event_publish_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_rows(given.order_facts(
        spark, sf_dir, "order_id", "order_timestamp", "customer_id", "quantity", "final_amount", "order_status",
        "is_first_order"))


@register
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders after draining three waves of events."""
    warehouse, _ = streams.ingest_waves(spark, sf_dir)
    return plain(warehouse.read("orders").select(*ORDER_COLUMNS, "revenue_per_unit", "order_hour", "order_date"))


@register
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected events after draining three waves."""
    warehouse, _ = streams.ingest_waves(spark, sf_dir)
    return _reasons(warehouse.read("rejects"))


@register
def stream_rejects_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rejects once all batches but the last are folded into a generation."""
    warehouse, _ = streams.ingest_waves(spark, sf_dir)
    if "rejects" not in fold_batches(warehouse, 0):
        raise RuntimeError("nothing was folded")
    return _reasons(warehouse.read("rejects"))


@register
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the micro-batches of three waves."""
    warehouse, _ = streams.ingest_waves(spark, sf_dir)
    return ingest_totals(warehouse.read("batch_metrics"))


@register
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts before and after all events come once more, under a new checkpoint."""
    warehouse, landing = streams.ingest_waves(spark, sf_dir)
    before = reports.row_count(warehouse.read("orders")).first()["row_count"]
    drain(landed_orders(spark, landing, by_name=True), warehouse, shared_folder(spark, "checkpoint"),
          streams.OPTIONS, seconds=None)
    return reports.row_count(warehouse.read("orders")).select(
        F.lit(before).cast("bigint").alias("rows_before"), F.col("row_count").alias("rows_after"))


@register
def hourly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain, quality gate and rollup of all days that got orders; the summary it leaves."""
    root = shared_folder(spark, "hourly")
    warehouse = Warehouse(spark, f"{root}/warehouse").create()
    streams.load_masters(spark, sf_dir, warehouse)
    for _ in streams.arriving_waves(spark, sf_dir, f"{root}/landing"):
        run_hourly(landed_orders(spark, f"{root}/landing", by_name=True), warehouse, f"{root}/checkpoint",
                   given.AS_OF, streams.OPTIONS, dates="stale", seconds=None, **given.PAYMENTS)
    return plain(warehouse.read("daily_summary").select(*SUMMARY_KEYS, *SUMMARY_MEASURES))


# The last orders of ``month_time`` are of the second of August.
MONTHS_END = "2001-08-03 00:00:00"


@register
def daily_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after three waves of orders, most of them of days that earlier waves had orders of, each added."""
    root = shared_folder(spark, "merged")
    warehouse = Warehouse(spark, f"{root}/warehouse").create()
    streams.load_masters(spark, sf_dir, warehouse)
    for _ in streams.arriving_waves(spark, sf_dir, f"{root}/landing", given.month_time()):
        run_hourly(landed_orders(spark, f"{root}/landing", by_name=True), warehouse, f"{root}/checkpoint",
                   MONTHS_END, streams.OPEN, dates="merged", seconds=None, **given.PAYMENTS)
    return plain(warehouse.read("daily_summary").select(*SUMMARY_KEYS, *SUMMARY_MEASURES))


# Orders of all months, found by the index of ids, and reports over what is stored.


_STORED = (*ORDER_COLUMNS, "revenue_per_unit", "order_hour", "order_date")
MONTHS_AS_OF = "1998-06-15 00:00:00"


@register
def stream_ingest_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders where copies of an order come with other dates."""
    return plain(streams.stored_months(spark, sf_dir).read("orders").select(*_STORED))


@register
def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders where each wave brings the earlier ones once more, and redelivered messages are dropped."""
    return plain(streams.ingest_redelivered(spark, sf_dir).read("orders").select(*_STORED))


@register
def order_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that the index has, each once however often it is written there."""
    return streams.stored_months(spark, sf_dir).read("order_keys").select("order_id").distinct()


@register
def stored_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.revenue_by_category(streams.stored_months(spark, sf_dir).read("orders"), MONTHS_AS_OF))


@register
def stored_revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.revenue_by_region(streams.stored_months(spark, sf_dir).read("orders"), MONTHS_AS_OF))


@register
def stored_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.daily_revenue_trend(streams.stored_months(spark, sf_dir).read("orders"), MONTHS_AS_OF))


@register
def stored_recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.recent_orders(streams.stored_months(spark, sf_dir).read("orders"), 20, given.AS_OF))


@register
def stored_hourly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(reports.hourly_orders(streams.stored_months(spark, sf_dir).read("orders"), "1998-06-01"))


@register
def stored_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_dq(streams.stored_months(spark, sf_dir).read("orders"), MONTHS_AS_OF)


@register
def stored_day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup of two single days, one of them twice, as the summary table then has it."""
    orders = streams.stored_months(spark, sf_dir).read("orders")
    own = Warehouse(spark, shared_folder(spark, "days")).create()
    for day in ("1998-06-01", "1998-06-02", "1998-06-01"):
        rollup.upsert_daily_summary(orders, own.path("daily_summary"), day=day, **given.PAYMENTS)
    return plain(own.read("daily_summary").select(*SUMMARY_KEYS, *SUMMARY_MEASURES))


@register
def stored_summary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the summary table holds for a day, after the rollup of that day and the next."""
    orders = streams.stored_months(spark, sf_dir).read("orders")
    own = Warehouse(spark, shared_folder(spark, "days")).create()
    for day in ("1998-06-01", "1998-06-02"):
        rollup.upsert_daily_summary(orders, own.path("daily_summary"), day=day, **given.PAYMENTS)
    return plain(rollup.summary_check(own.read("daily_summary"), "1998-06-01"))


@register
def master_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys stored and all rows refused by two loads of customers and one each of products and stores."""
    warehouse = streams.load_all_masters(spark, sf_dir)
    found = warehouse.read("master_rejects").select(
        "table_name", "row_key", "load_label", F.array_join("reject_reasons", ",").alias("reject_reasons"))
    for table, key in (("customers", "customer_id"), ("products", "product_id"), ("stores", "store_id")):
        found = found.unionByName(warehouse.read(table).select(
            F.lit(table).alias("table_name"), F.col(key).alias("row_key"), F.lit("stored").alias("load_label"),
            F.lit("").alias("reject_reasons")))
    return found


@register
def format_violations_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers and text widths of orders, products and stores."""
    text = {"customer_gender": "store_name", "store_type": "store_name", "device_type": "brand", "source": "category"}
    orders = given.order_facts(spark, sf_dir, "order_id", "customer_id", "product_id", "store_id", "customer_city",
                               "customer_region", "product_name", "category", "brand", "store_city", "store_region",
                               "payment_method", "order_status", "store_name").withColumns(
        {**{name: F.col(of) for name, of in text.items()},
         **{name: F.col(name).cast("string") for name in ("customer_id", "product_id", "store_id")}})
    found = None
    for table, rows in (("orders", orders), ("products", given.product_master(spark, sf_dir)),
                        ("stores", given.store_master(spark, sf_dir))):
        tagged = constraints.tag_violations(rows, constraints.format_rules(table))
        counts = (tagged.select(F.explode("reject_reasons").alias("reason")).groupBy("reason")
                  .agg(F.count("*").alias("rows")).select(F.lit(table).alias("table_name"), "reason", "rows"))
        found = counts if found is None else found.unionByName(counts)
    return found

