from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillmark.operators import clean

POS = ("transaction_id string, transaction_date string, store_id string, product_id string, quantity int, "
       "unit_price double, discount double, total_amount double, category string")
DIRTY = [
    ("whole", "2024-02-28", "north", "lamp", 4, 12.50, 0.20, 40.00, "Home"),
    ("returned", "2024-02-28", "north", "vase", -2, 8.00, 0.00, -16.00, "Home"),
    ("undated", "28th of Feb", "south", "rug", 1, 99.00, 0.00, 99.00, "Home"),
    (None, "2024-02-29", "south", "desk", 1, 210.00, 0.00, 210.00, "Office"),
    ("nameless", "2024-02-29", "south", "pen", 10, 1.25, 0.00, 12.50, "Office"),
    ("whole", "2024-02-28", "north", "lamp", 4, 12.50, 0.20, 40.00, "Home"),
    ("rounded", "2024-03-01", "west", "chair", 3, 33.33, 0.05, 94.99, "Office"),
]


def test_dirty_sales_are_cleaned(spark):
    cleaned = {r["transaction_id"]: r for r in clean.clean_pos(spark.createDataFrame(DIRTY, POS)).collect()}
    assert set(cleaned) == {"whole", "nameless", "rounded"}
    assert cleaned["whole"]["net_revenue"] == Decimal("40.00")
    assert cleaned["rounded"]["net_revenue"] == Decimal("94.99")
    assert cleaned["nameless"]["product_name"] == "pen"
    assert cleaned["nameless"]["transaction_date"] == dt.date(2024, 2, 29)


def test_missing_discount_is_none_and_net_is_gross_less_discount(spark):
    lines = [("A", "2023-01-01", "S", "P", 7, 0.333, None, 0.0, "c"), ("B", "2023-01-01", "S", "P", 3, 9.99, 0.333, 0.0, "c")]
    for row in clean.clean_pos(spark.createDataFrame(lines, POS)).collect():
        assert row["gross_revenue"] - row["discount_amount"] == row["net_revenue"]
        assert row["discount"] is not None


def test_first_line_by_date_wins_and_ties_are_settled(spark):
    lines = [("A", "2023-01-02", "S", "P", 1, 1.0, 0.0, 0.0, "c"), ("A", "2023-01-01", "S2", "P", 2, 1.0, 0.0, 0.0, "c"),
             ("A", "2023-01-01", "S1", "P", 3, 1.0, 0.0, 0.0, "c")]
    for order in (lines, lines[::-1]):
        assert [r["store_id"] for r in clean.clean_pos(spark.createDataFrame(order, POS)).collect()] == ["S1"]


def test_line_key_keeps_every_line_of_a_transaction(spark):
    lines = spark.createDataFrame([("A", 1, "2023-01-01", "S", "P", 1, 1.0, 0.0), ("A", 2, "2023-01-01", "S", "P", 1, 1.0, 0.0)],
                                  "transaction_id string, line int, transaction_date string, store_id string, "
                                  "product_id string, quantity int, unit_price double, discount double")
    assert clean.clean_pos(lines, ("transaction_id", "line")).count() == 2
    assert clean.clean_pos(lines).count() == 1


def test_time_features(spark):
    days = spark.createDataFrame([("2023-06-15",), ("2023-11-01",), ("2023-06-17",), ("2023-01-01",)], "d string").selectExpr(
        "cast(d as date) transaction_date")
    found = {str(r["transaction_date"]): r for r in clean.with_time_features(days).collect()}
    assert found["2023-06-15"]["day_of_week"] == 4 and not found["2023-06-15"]["is_weekend"]
    assert found["2023-11-01"]["quarter"] == 4
    assert found["2023-06-17"]["is_weekend"]
    assert found["2023-01-01"]["day_of_week"] == 7 and found["2023-01-01"]["week_of_year"] == 52


EVENT = "event_id string, event_type string, event_timestamp string, product_id string, price double"


def test_events_are_cleaned(spark):
    events = [
        ("1", "purchase", "2023-06-15T10:00:00", "P", 5.0),
        ("1", "purchase", "2023-06-15T09:00:00Z", "P", 5.0),
        ("2", "unknown", "2023-06-15T10:00:00", "P", 5.0),
        ("3", "purchase", "2023-06-15T10:00:00", None, 5.0),
        ("4", "purchase", "2023-06-15T10:00:00", "P", -1.0),
        ("5", "add_to_cart", "2023-06-15T10:00:00.250", "P", None),
        ("6", "add_to_cart", "nonsense", "P", 0.0),
    ]
    found = {r["event_id"]: r["event_timestamp"] for r in clean.clean_events(spark.createDataFrame(events, EVENT)).collect()}
    assert found == {"1": dt.datetime(2023, 6, 15, 9), "5": dt.datetime(2023, 6, 15, 10, 0, 0, 250000), "6": None}
