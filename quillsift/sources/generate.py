"""Dirty order rows for tests and trials, computed from order ids.

Each value depends only on the id and the seed, so tasks need no shared state and a rerun, in any
partitioning, gives the same rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A multiplier and modulus that spread neighbouring ids evenly.
_MULTIPLIER, _MODULUS = 48271, 2147483647

# Names that the generated rows draw from; any will do.
CUSTOMERS = ["alice", "bob", "charlie", "diana", "eve", "frank", "grace", "henry"]
PRODUCTS = ["laptop", "phone", "tablet", "monitor", "keyboard"]
SHOPPERS = ["Ines Vale", "Omar Quist", "Lena Brook", "Tariq Stone", "Mia Fjord", "Noah Reed"]
GOODS = ["desk lamp", "tea kettle", "rain coat", "chess set", "seed box", "wall clock"]
KINDS = ["home", "kitchen", "outdoor", "games"]
LANDS = ["Norway", "Peru", "Kenya", "Japan", "Canada"]
PAYMENTS = ["card", "transfer", "voucher"]
STATES = ["placed", "packed", "shipped", "returned"]


def draw(order_id: Column, salt: int, sides: int) -> Column:
    """A number in [0, sides) fixed by the id and the salt."""
    start = F.pmod(order_id + F.lit(salt * 7919), F.lit(_MODULUS))
    mixed = F.pmod(start * _MULTIPLIER, F.lit(_MODULUS))
    return F.pmod(F.pmod(mixed * _MULTIPLIER, F.lit(_MODULUS)), F.lit(sides))


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number + 1).cast("int"))


def gen_dirty_orders(ids: DataFrame, column: str = "order_id", seed: int = 0) -> DataFrame:
    """Orders for the given ids: one in five quantities missing or negative, one in seven
    prices missing, text in mixed case and padding, dates in three spellings."""
    key = F.col(column).cast("bigint")

    def die(salt: int, sides: int) -> Column:
        return draw(key, seed * 100 + salt, sides)

    name = _pick(CUSTOMERS, die(1, len(CUSTOMERS)))
    day = F.date_add(F.lit("2024-01-01").cast("date"), die(2, 366).cast("int"))
    spelling = die(3, 3)
    quantity = die(4, 10)
    return ids.select(
        key.alias("order_id"),
        F.when(die(5, 3) == 0, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
        .otherwise(name)
        .alias("customer"),
        _pick(PRODUCTS, die(6, len(PRODUCTS))).alias("product"),
        F.when(quantity == 0, None)
        .when(quantity == 1, F.lit(-1))
        .otherwise(quantity - 1)
        .cast("double")
        .alias("quantity"),
        F.when(die(7, 7) == 0, None)
        .otherwise(((die(8, 100000) + 100) / 100).cast("decimal(12,2)"))
        .alias("unit_price"),
        F.when(spelling == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(spelling == 1, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
        .alias("order_date"),
    )


class Dirt(NamedTuple):
    """How many in a thousand rows of a shop feed have each kind of dirt."""

    copies: int = 30
    no_email: int = 70
    no_country: int = 30
    no_discount: int = 400
    no_coupon: int = 700
    negative_price: int = 10
    zero_price: int = 5
    dollars: int = 100
    units: int = 50
    odd_case: int = 300
    us_dates: int = 300
    eu_dates: int = 300


CLEAN = Dirt(*[0] * len(Dirt._fields))


def gen_shop_orders(
    ids: DataFrame,
    column: str = "order_id",
    seed: int = 0,
    batch: int = 0,
    dirt: Dirt = Dirt(),
) -> DataFrame:
    """A shop's raw orders for the given ids, as ``schemas.ECOMMERCE_RAW``.

    What was ordered depends on the id and the seed alone; its status, and whether the row is sent
    twice, on the batch as well. So batches of overlapping ids send some orders again, in a later
    state, and any partitioning gives the same rows.
    """
    key = F.col(column).cast("bigint")

    def die(salt: int, sides: int) -> Column:
        return draw(key, seed * 1000 + salt, sides)

    def happens(salt: int, rate: int) -> Column:
        return die(salt, 1000) < rate

    def cased(value: Column, salt: int) -> Column:
        kind = die(salt, 1000)
        upper, lower, padded = (dirt.odd_case * i // 3 for i in (1, 2, 3))
        return (
            F.when(kind < upper, F.upper(value))
            .when(kind < lower, F.lower(value))
            .when(kind < padded, F.concat(F.lit("  "), value, F.lit(" ")))
            .otherwise(value)
        )

    number = die(1, 9) + 1
    cents = die(2, 200_000) + 100
    price, total = ((c / 100).cast("decimal(12,2)") for c in (cents, cents * number))
    day = F.date_add(F.lit("2022-01-01").cast("date"), die(3, 1461).cast("int"))
    shopper, spelling, sign = _pick(SHOPPERS, die(4, len(SHOPPERS))), die(5, 1000), die(6, 1000)
    mail = F.concat(F.lower(F.replace(shopper, F.lit(" "), F.lit("."))), F.lit("@example.org"))
    # Salts from 100 on change with the batch.
    twice = draw(key, seed * 1000 + 100 + batch, 1000) < dirt.copies
    state = draw(key, seed * 1000 + 500 + batch, len(STATES))
    rows = ids.select(
        key.alias("order_id"),
        cased(shopper, 7).alias("customer_name"),
        F.when(~happens(8, dirt.no_email), mail).alias("customer_email"),
        F.when(spelling < dirt.us_dates, F.date_format(day, "MM/dd/yyyy"))
        .when(spelling < dirt.us_dates + dirt.eu_dates, F.date_format(day, "dd-MM-yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("order_date"),
        cased(_pick(KINDS, die(9, len(KINDS))), 10).alias("product_category"),
        _pick(GOODS, die(11, len(GOODS))).alias("product_name"),
        F.when(happens(12, dirt.units), F.concat(number.cast("string"), F.lit(" units")))
        .otherwise(number.cast("string"))
        .alias("quantity"),
        F.when(sign < dirt.negative_price, -price)
        .when(sign < dirt.negative_price + dirt.zero_price, price * 0)
        .otherwise(price)
        .cast("decimal(12,2)")
        .alias("unit_price"),
        F.when(happens(13, dirt.dollars), F.concat(F.lit("$"), F.format_number(total, 2)))
        .otherwise(total.cast("string"))
        .alias("amount"),
        F.when(~happens(14, dirt.no_discount), die(15, 30).cast("double")).alias("discount_pct"),
        F.when(~happens(16, dirt.no_coupon), F.lit("SAVE10")).alias("coupon_code"),
        cased(_pick(PAYMENTS, die(17, len(PAYMENTS))), 18).alias("payment_method"),
        F.when(~happens(19, dirt.no_country), cased(_pick(LANDS, die(20, len(LANDS))), 21)).alias(
            "shipping_country"
        ),
        _pick(STATES, state).alias("order_status"),
        twice.alias("twice"),
    )
    sent = F.explode(F.sequence(F.lit(0), F.when(F.col("twice"), 1).otherwise(0)))
    return rows.withColumn("sent", sent).drop("twice", "sent")


def order_ids(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(1, rows + 1).withColumnRenamed("id", "order_id")
