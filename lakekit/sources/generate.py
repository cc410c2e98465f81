"""Synthetic sales and customers, generated on the executors from hashed keys.

Every value is a function of (seed, store, slot, order, item), so a lost task is regenerated identically
and two runs with one seed agree. There is no driver loop: the number of rows follows the store table
and the date range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalar import busy_time

# Sizes with their price, notes, fruits, payment methods, order sources, states, countries.
SIZES = {"Small": 5, "Medium": 7, "Large": 9}
NOTES = ["extra ice", "no ice", "no sugar", "extra sugar"]
FRUITS = ["Apple", "Orange", "Pineapple", "Mango", "Peach", "Banana", "Strawberry", "Blueberry", "Raspberry", "Kiwi", "Passionfruit"]
PAYMENTS = ["CASH", "ONLINE", "CARD"]
SOURCES = ["ONLINE", "IN-STORE"]
COUNTRIES = ["FR", "USA", "SPAIN"]
# Shares of completed orders, of pending among the others, of members, of ready mixes, of items without notes.
COMPLETED, PENDING, MEMBER, READY_MIX, NO_NOTES = 0.9, 0.7, 0.2, 0.7, 0.8
MAX_MEMBER = 100
STORE_DAYS_PER_TASK = 64  # about 40,000 orders


def uniform(seed: int, tag: str, *keys) -> Column:
    """A number in [0, 1) from the hash of the keys."""
    h = F.xxhash64(F.lit(seed), F.lit(tag), *keys)
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def pick(values: Sequence, u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def between(lo: int, hi: int, u: Column) -> Column:
    return (F.floor(u * (hi - lo + 1)) + lo).cast("int")


def gen_orders(
    stores: DataFrame,
    start: str,
    end: str,
    products: Sequence[str],
    seed: int = 42,
    hours: tuple[int, int] = (7, 20),
    holidays: DataFrame | None = None,
    batch: int = 0,
) -> DataFrame:
    """Orders of every store for every day from ``start`` to ``end`` and opening hour, in 10-minute slots.

    ``stores``   columns ``store_id`` and ``country``
    ``hours``    first and last hour with orders, both included
    ``holidays`` columns ``country`` and ``date``
    ``products`` names; the list is a literal in the plan
    ``batch``    a later batch with the same days gets other orders
    """
    if not products:
        raise ValueError("no products")
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")
    slots = stores.select("store_id", "country", days)
    # the few rows here grow a thousandfold below: spread them first, by a number that AQE does not lower
    # where stores are many, all days of one go to one task: counts per store or per store and time then need no shuffle of the orders
    days_of_stores, n_stores = slots.count(), stores.count()
    tasks = -(-days_of_stores // STORE_DAYS_PER_TASK) or 1
    slots = slots.repartition(tasks, *(["store_id"] if n_stores >= 4 * tasks else ["store_id", "day"]))
    slots = slots.select("*", F.explode(F.sequence(F.lit(hours[0]), F.lit(hours[1]))).alias("hour"))
    slots = slots.select("*", F.explode(F.sequence(F.lit(0), F.lit(50), F.lit(10))).alias("minute"))
    if holidays is not None:
        hol = holidays.select("country", F.col("date").alias("day"), F.lit(True).alias("holiday")).distinct()
        slots = slots.join(hol, ["country", "day"], "left")
    else:
        slots = slots.withColumn("holiday", F.lit(False))
    ts = F.make_timestamp(F.year("day"), F.month("day"), F.dayofmonth("day"), F.col("hour"), F.col("minute"), F.lit(0))
    slots = slots.withColumns({"t": ts, "busy": busy_time(F.col("day"), F.col("hour"), F.coalesce("holiday", F.lit(False)))})

    at = [F.lit(batch), F.col("store_id"), F.col("t")]
    u = uniform(seed, "orders", *at)
    n = F.when(F.col("busy"), between(4, 20, u)).otherwise(between(1, 5, u))
    o = slots.select("*", F.explode(F.sequence(F.lit(1), n)).alias("order_no"))
    key = [*at, F.col("order_no")]
    r = lambda tag, *more: uniform(seed, tag, *key, *more)

    def item(i: Column) -> Column:
        size = pick(list(SIZES), r("size", i))
        ready = r("ready", i) < READY_MIX
        cost = F.element_at(F.create_map(*[F.lit(x) for kv in SIZES.items() for x in kv]), size)
        fruit = F.transform(F.sequence(F.lit(1), between(1, 5, r("n_fruit", i))), lambda f: pick(FRUITS, r("fruit", i, f)))
        return F.struct(
            cost.alias("cost"),
            F.when(ready, pick(list(products), r("mix", i))).otherwise("custom").alias("id"),
            F.when(~ready, fruit).alias("ingredients"),
            F.when(r("noted", i) < NO_NOTES, "").otherwise(pick(NOTES, r("note", i))).alias("notes"),
            size.alias("size"),
        )

    state = F.when(r("state") < COMPLETED, "COMPLETED").when(r("state2") < PENDING, "PENDING").otherwise("CANCELED")
    return o.select(
        F.sha1(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])).alias("id"),
        "store_id",
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        state.alias("state"),
        pick(PAYMENTS, r("payment")).alias("payment_method"),
        F.transform(F.sequence(F.lit(1), between(1, 5, r("items"))), item).alias("sale_items"),
        F.when(r("member") < MEMBER, between(0, MAX_MEMBER, r("who"))).otherwise(0).cast("long").alias("customer_id"),
        pick(SOURCES, r("source")).alias("order_source"),
    )


def more_orders(stores: DataFrame, day: str, products: Sequence[str], batch: int, seed: int = 42) -> DataFrame:
    """A later batch: one hour of orders of one store, both chosen by the batch number."""
    chosen = stores.orderBy(F.xxhash64(F.lit(seed), F.lit(batch), "store_id"), "store_id").limit(1)
    hour = 7 + (seed + batch * 7) % 16
    return gen_orders(chosen, day, day, products, seed, (hour, hour), batch=batch)


def gen_customers(spark: SparkSession, n: int, seed: int = 42, base: DataFrame | None = None) -> DataFrame:
    """Customers ``0..n-1``, or one for every ``id`` of ``base``; names are derived from hashes."""
    df = base if base is not None else spark.range(n)
    u = lambda tag: uniform(seed, tag, F.col("id"))
    token = lambda tag, width: F.substring(F.sha1(F.concat_ws("|", F.lit(f"{seed}{tag}"), F.col("id").cast("string"))), 1, width)
    first, last = F.initcap(F.concat(F.lit("n"), token("first", 6))), F.initcap(F.concat(F.lit("m"), token("last", 8)))
    return df.select(
        "id",
        F.date_format(F.timestamp_seconds(F.lit(1672531200) + F.floor(u("date") * 2592000)), "MM-dd-yyyy HH:mm:ss").alias("creation_date"),
        first.alias("customer_firstname"),
        last.alias("customer_lastname"),
        pick(COUNTRIES, u("country")).alias("country"),
        F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com"))).alias("customer_email"),
        F.concat(between(1, 999, u("no")).cast("string"), F.lit(" "), F.initcap(token("street", 7)), F.lit(" Street")).alias("address"),
        F.round(u("gender") + 0.2).alias("gender"),
        F.round(u("age") * 10).alias("age_group"),
    )
