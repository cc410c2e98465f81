"""What a business user asks for: clean sales, sale items, weather hours and the reports over them.

All functions take and return DataFrames with the columns of the shop model:
sales (id, ts, store_id, customer_id, order_source, state, sale_items), stores (id, name, city,
country_code), sale items (sale_id, sale_ts, item_number, product_id, product_cost, ...), weather
(latitude, longitude, time, temperature_2m, rain).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nested import parse_items, zip_rows
from ..functions.scalar import case_in, composite_id, last_days

# Expectations on clean sales and sale items.
SALES_RULES = {
    "Location has to be 5 characters long": "length(store_id) = 5",
    "Only CANCELED and COMPLETED transactions are allowed": "order_state in ('CANCELED', 'COMPLETED')",
}
ITEM_ELEMENT = "cost: STRING, id: STRING, ingredients: STRING, notes: STRING, size: STRING"


def item_rules(custom: str = "Custom", ignore_case: bool = False) -> dict[str, str]:
    """Custom products must list their ingredients; compared as written unless ``ignore_case``."""
    left = "lower(product_id)" if ignore_case else "product_id"
    right = custom.lower() if ignore_case else custom
    return {"All custom juice must have ingredients": f"not ({left} = '{right}' and product_ingredients is null)"}


def sales_clean(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "ts", "store_id", "customer_id", composite_id(F.col("store_id"), F.col("customer_id")).alias("unique_customer_id"),
        "order_source", F.col("state").alias("order_state"), "sale_items",
    )


def sale_items(raw: DataFrame) -> DataFrame:
    """One row per item of the JSON array ``sale_items``."""
    x = parse_items(raw.withColumnRenamed("id", "sale_id"), "sale_items", ITEM_ELEMENT, ["sale_id", "ts", "store_id"])
    return x.select(
        composite_id(F.col("sale_id"), F.col("pos")).alias("id"), "sale_id", F.col("ts").alias("sale_ts"), "store_id",
        F.col("pos").alias("item_number"), F.col("id").alias("product_id"), F.col("size").alias("product_size"),
        F.col("notes").alias("product_notes"), F.col("cost").alias("product_cost"), F.col("ingredients").alias("product_ingredients"),
    )


def weather_hours(raw: DataFrame, hourly_schema: str = "rain array<double>, temperature_2m array<double>, time array<string>", key_sep: str = "|") -> DataFrame:
    """Parallel hourly arrays of a payload to one row per place and hour."""
    meta = ["latitude", "longitude", "timezone", "generationtime_ms"]
    x = raw.select(*meta, F.from_json("hourly", hourly_schema).alias("h"))
    x = zip_rows(x, {"time": "h.time", "temperature_2m": "h.temperature_2m", "rain": "h.rain"}, meta)
    return x.select(F.concat_ws(key_sep, F.col("latitude").cast("string"), F.col("longitude").cast("string"), "time").alias("pk"), "*")


def country_sales(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales per country; sales of unknown stores are left out, as an inner join does."""
    s = stores.select(F.col("id").alias("_store"), "country_code")
    return sales.join(s, F.col("store_id") == F.col("_store")).groupBy("country_code").agg(F.count_distinct("id").alias("number_of_sales"))


def daily_sales_and_weather(items: DataFrame, weather: DataFrame, day: Callable[[str], Column] = lambda c: F.date_trunc("day", c)) -> DataFrame:
    """Average and total sale value per day with the day's average temperature.

    Costs are summed as decimals, so the result does not depend on the order of the partitions.
    """
    cost = F.col("product_cost").cast("decimal(18,2)")
    per_sale = items.groupBy("sale_ts", "sale_id").agg(F.sum(cost).alias("total"))
    s = per_sale.groupBy(day("sale_ts").alias("day")).agg(
        (F.sum("total").cast("double") / F.count("total")).alias("average_daily_cost"), F.sum("total").cast("double").alias("total_daily_cost"))
    t = F.col("temperature_2m").cast("decimal(18,4)")
    w = weather.where("temperature_2m is not null").groupBy(day("time").alias("day")).agg((F.sum(t).cast("double") / F.count(t)).alias("average_temperature"))
    return s.join(w, "day", "left").select("day", "average_daily_cost", "total_daily_cost", "average_temperature")


def store_last_days(sales: DataFrame, store: str, as_of, days: int = 7) -> DataFrame:
    return sales.where((F.col("store_id") == store) & last_days(F.col("ts").cast("timestamp"), as_of, days))


def orders_by_city(sales: DataFrame, stores: DataFrame) -> DataFrame:
    st = stores.select(F.col("id").alias("_store"), "city", "country_code", F.col("name").alias("store_name"))
    j = sales.join(st, F.col("store_id") == F.col("_store"))
    return j.groupBy("store_id", "order_source", "order_state", "city", "country_code", "store_name").agg(F.count(F.lit(1)).alias("cnt"))


def cancelled_per_store(by_city: DataFrame, state: str = "CANCELED") -> DataFrame:
    return by_city.where(F.col("order_state") == state).select("store_name", F.col("cnt").alias("canceled_per_store"))


def stores_per_country(stores: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    s = stores.withColumn("store_country", case_in(F.col("id"), groups))
    return s.groupBy("store_country").agg(F.count("id").alias("number_of_stores"))


def dinner(menu: DataFrame) -> DataFrame:
    return menu.select("recipe_id", F.concat("app", F.lit(" + "), "main", F.lit(" + "), "desert").alias("full_menu"))


def dinner_price(dinner_: DataFrame, price: DataFrame) -> DataFrame:
    return dinner_.join(price, on="recipe_id")


def popular_combinations(items: DataFrame, sale: str, item: str, k: int = 20) -> DataFrame:
    """The ``k`` sets of items most often sold together, one row per set and item.

    A set is counted by a fingerprint of its distinct items (number, sum and xor of two hashes), which is
    combined row by row, so the items of a sale are never gathered. Only the winners are listed, through
    their first sale; ties go to the set with the smaller first sale.
    """
    pairs = items.select(F.col(sale).alias("_s"), F.col(item).alias("item")).distinct()
    per_sale = pairs.groupBy("_s").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("item")).alias("x"), F.sum(F.xxhash64(F.lit("+"), "item").cast("decimal(20,0)")).alias("h"))
    combos = per_sale.groupBy("c", "x", "h").agg(F.count(F.lit(1)).alias("n_sales"), F.min("_s").alias("first_sale"))
    top = combos.orderBy(F.desc("n_sales"), "first_sale").limit(k).select("n_sales", "first_sale")
    return pairs.join(top, F.col("_s") == F.col("first_sale")).select("n_sales", "first_sale", "item")
