"""The test tables seen as the retail model.

Order lines are sales, parts are products, suppliers are stores, and the user
events are shop events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.joins import dealt, lookup, parts_of
from tillmark.functions.numbers import money
from tillmark.operators.star import calendar_dim

# Holidays that fall on the same date every year (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (2, 14, "Valentine's Day"),
    (3, 17, "St. Patrick's Day"),
    (7, 4, "Independence Day"),
    (10, 31, "Halloween"),
    (11, 11, "Veterans Day"),
    (12, 24, "Christmas Eve"),
    (12, 25, "Christmas Day"),
    (12, 31, "New Year's Eve"),
]

# Shop event types the test tables' events stand for; others are unknown to the shop.
EVENT_TYPE_OF = {"view": "product_view", "click": "add_to_cart", "purchase": "purchase", "error": "wishlist_add"}

_LONG, _INT, _DOUBLE, _TEXT, _TIME = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Known schemas: without them every read starts with a job that looks one up.
SCHEMAS = {
    "region": [("r_regionkey", _INT), ("r_name", _TEXT)],
    "nation": [("n_nationkey", _INT), ("n_name", _TEXT), ("n_regionkey", _INT)],
    "supplier": [("s_suppkey", _LONG), ("s_name", _TEXT), ("s_nationkey", _INT), ("s_acctbal", _DOUBLE)],
    "part": [("p_partkey", _LONG), ("p_name", _TEXT), ("p_brand", _TEXT), ("p_type", _TEXT), ("p_size", _INT),
             ("p_retailprice", _DOUBLE)],
    "orders": [("o_orderkey", _LONG), ("o_custkey", _LONG), ("o_orderstatus", _TEXT), ("o_totalprice", _DOUBLE),
               ("o_orderdate", _TIME), ("o_orderpriority", _TEXT)],
    "lineitem": [("l_orderkey", _LONG), ("l_partkey", _LONG), ("l_suppkey", _LONG), ("l_linenumber", _INT),
                 ("l_quantity", _DOUBLE), ("l_extendedprice", _DOUBLE), ("l_discount", _DOUBLE), ("l_tax", _DOUBLE),
                 ("l_returnflag", _TEXT), ("l_linestatus", _TEXT), ("l_shipdate", _TIME)],
    "events": [("event_id", _LONG), ("ts", _TIME), ("user_id", _LONG), ("event_type", _TEXT), ("value", _DOUBLE),
               ("props", _TEXT)],
}


def schema_of(name: str) -> T.StructType:
    return T.StructType([T.StructField(column, kind) for column, kind in SCHEMAS[name]])


def whole_cents(price: str) -> Column:
    """Cents of a price stored as a double with two decimals."""
    return F.rint(F.col(price) * 100).cast("long")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(schema_of(name)).parquet(f"{self.sf_dir}/{name}.parquet")

    def parts(self) -> int:
        """Parts that the sales rows are dealt into."""
        return parts_of(self.raw("lineitem"))

    def sales(self, dated: bool = True, cost: bool = False) -> DataFrame:
        """The sales rows.  Date, customer and payment come from the order, cost from the product."""
        lines = self.raw("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_linestatus").alias("channel"),
            F.col("l_quantity").cast("int").alias("quantity_sold"),
            whole_cents("l_extendedprice").alias("gross_cents"),
            # Rounded to the cent, as the sales lines store it.
            F.expr("(cast(rint(l_extendedprice * 100) as bigint) * cast(rint(l_discount * 100) as bigint) + 50) div 100")
            .alias("discount_cents"),
        ).withColumn("net_cents", F.col("gross_cents") - F.col("discount_cents"))
        if dated:
            orders = self.raw("orders").select(
                F.col("o_orderkey").alias("transaction_id"),
                F.col("o_orderdate").cast("date").alias("sale_date"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderpriority").alias("payment_method"))
            # An order has few lines, so no key is hot.
            lines, orders = dealt(lines, orders, "transaction_id", self.parts())
            lines = lines.join(orders, "transaction_id")
        if cost:
            costs = self.raw("part").select(F.col("p_partkey").alias("product_id"), whole_cents("p_retailprice").alias("unit_cents"))
            lines = lines.join(costs, "product_id").withColumn(
                "profit_cents", F.col("net_cents") - F.col("quantity_sold") * F.col("unit_cents")).drop("unit_cents")
        return lines

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
            money("p_retailprice").alias("unit_price"), F.lit(True).alias("is_active"))

    def stores(self) -> DataFrame:
        """Suppliers with nation and region: one row per supplier, so as small as that table."""
        suppliers = self.raw("supplier")
        nations = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return lookup(suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("city"),
            F.col("n_name").alias("state"), F.col("r_name").alias("region")), as_small_as=suppliers)

    def order_span(self) -> DataFrame:
        """First and last order day."""
        day = F.col("o_orderdate").cast("date")
        return self.raw("orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))

    def holidays(self) -> DataFrame:
        """The fixed-date holidays in every year that has orders."""
        years = self.raw("orders").select(F.year("o_orderdate").alias("y")).distinct()
        listed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("holiday_name"))
                           for m, d, n in FIXED_HOLIDAYS])
        # Nine rows a year, which Spark cannot know from the size of the orders.
        return F.broadcast(years.select("y", F.explode(listed).alias("h")).select(
            F.make_date("y", "h.m", "h.d").alias("holiday_date"), "h.holiday_name", F.lit(True).alias("is_holiday")))

    def calendar(self) -> DataFrame:
        return calendar_dim(self.order_span(), self.holidays())

    def weather(self) -> DataFrame:
        """Stand-in readings by day and state: extremes over what the state's stores shipped that day."""
        shipped = self.raw("lineitem").join(
            self.stores().select("store_id", "state"), F.col("l_suppkey") == F.col("store_id"))
        return shipped.groupBy(F.col("l_shipdate").cast("date").alias("weather_date"), F.col("state").alias("weather_state")).agg(
            (F.max("l_quantity") + 50).alias("temp_high_f"), F.max("l_discount").alias("precipitation_in"),
            F.max("l_returnflag").alias("weather_condition"))

    def raw_pos(self) -> DataFrame:
        """Sales lines as the tills deliver them: text dates, doubles, duplicates and returns included."""
        lines = self.raw("lineitem").join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        priced = lines.join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
        return priced.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            F.col("o_orderdate").cast("date").cast("string").alias("transaction_date"),
            F.col("l_suppkey").cast("string").alias("store_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            # Economy products come without a name, returned lines count negative, and
            # no discount is left empty.
            F.when(F.col("p_type") != "ECONOMY", F.col("p_name")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
            .cast("int").alias("quantity"),
            F.col("p_retailprice").alias("unit_price"),
            F.nullif("l_discount", F.lit(0.0)).alias("discount"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("customer_id"),
        )

    # -- events ---------------------------------------------------------------

    def _shop_events(self, events: DataFrame) -> DataFrame:
        kind = F.col("event_type")
        for known, shop in EVENT_TYPE_OF.items():
            kind = F.when(F.col("event_type") == known, F.lit(shop)).otherwise(kind)
        product = F.get_json_object("props", "$.k")
        return events.select(
            F.col("event_id").cast("string").alias("event_id"),
            kind.alias("event_type"),
            F.col("ts"),
            F.concat_ws("/", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string")).alias("session_id"),
            F.col("user_id").cast("string").alias("user_id"),
            # Product 0 stands for a missing one, and errors carry a negative price.
            F.nullif(product, F.lit("0")).alias("product_id"),
            F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value"))
            .cast("decimal(10,2)").alias("price"),
        )

    def events(self) -> DataFrame:
        """Shop events, typed, one row each."""
        return self._shop_events(self.raw("events"))

    def event_stream(self) -> DataFrame:
        """The events table as a stream."""
        return self._shop_events(
            self.spark.readStream.schema(schema_of("events")).option("pathGlobFilter", "events.parquet").parquet(self.sf_dir))

    @staticmethod
    def as_json(events: DataFrame) -> DataFrame:
        """Shop events as the topic carries them: one JSON text per event."""
        null = F.lit(None).cast("string")
        return events.select(F.to_json(F.struct(
            "event_id", "event_type",
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
            "session_id", "user_id", "product_id", null.alias("category"),
            F.col("price").cast("string").alias("price"), F.lit("1").alias("quantity"),
            F.lit("web").alias("device"), null.alias("platform"), null.alias("referrer"),
            F.struct(F.lit("US").alias("country"), F.concat(F.lit("S"), F.substring("user_id", 1, 1)).alias("state")).alias("geo"),
        )).alias("value"))
