"""Schemas of the source tables and of the tables made from them."""

from __future__ import annotations

# Column names and types.
MARKET_CSV = (
    "date STRING, admin1 STRING, admin2 STRING, market STRING, latitude STRING, longitude STRING, "
    "category STRING, commodity STRING, unit STRING, priceflag STRING, pricetype STRING, "
    "currency STRING, price STRING, usdprice STRING"
)
PRODUCER_PRICE = (
    "area STRING, area_code STRING, item STRING, item_code STRING, element STRING, year INT, "
    "unit STRING, value STRING, flag STRING"
)
FOOD_BALANCE = (
    "area STRING, area_code STRING, item STRING, item_code STRING, element STRING, "
    "element_code STRING, year INT, unit STRING, value STRING, flag STRING"
)
PANEL = "product STRING, region STRING, date DATE, price DOUBLE, price_std DOUBLE, record_count BIGINT"

# Market file header to standard name, in output order.
MARKET_COLUMNS = {
    "date": "date",
    "admin1": "region",
    "admin2": "district",
    "market": "market",
    "latitude": "latitude",
    "longitude": "longitude",
    "category": "category",
    "commodity": "product",
    "unit": "unit",
    "priceflag": "price_flag",
    "pricetype": "price_type",
    "currency": "currency",
    "price": "price",
    "usdprice": "price_usd",
}
