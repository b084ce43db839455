"""Region and product dimensions: fixed lists of a few rows, small enough to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Name, code, latitude, longitude, province number.
REGIONS = [
    ("Alger", "ALG", 36.7538, 3.0588, 16),
    ("Oran", "ORA", 35.6969, -0.6331, 31),
    ("Constantine", "CON", 36.3650, 6.6147, 25),
    ("Annaba", "ANN", 36.9000, 7.7667, 23),
    ("Tlemcen", "TLE", 34.8828, -1.3167, 13),
    ("Sétif", "SET", 36.1833, 5.4000, 19),
    ("Blida", "BLI", 36.4703, 2.8277, 9),
    ("Batna", "BAT", 35.5560, 6.1740, 5),
    ("Biskra", "BIS", 34.8500, 5.7333, 7),
    ("Béjaïa", "BEJ", 36.7509, 5.0564, 6),
]

# Category, name, code, unit, typical price range.
PRODUCTS = [
    ("vegetables", "Tomates", "TOM", "kg", [30.0, 150.0]),
    ("vegetables", "Pommes de terre", "POT", "kg", [30.0, 100.0]),
    ("vegetables", "Oignons", "ONI", "kg", [30.0, 120.0]),
    ("vegetables", "Carottes", "CAR", "kg", [40.0, 100.0]),
    ("proteins", "Poulet", "CHK", "kg", [280.0, 500.0]),
    ("proteins", "Viande rouge (mouton)", "LAM", "kg", [900.0, 1800.0]),
    ("proteins", "Viande rouge (boeuf)", "BEF", "kg", [1000.0, 2000.0]),
    ("proteins", "Oeufs", "EGG", "dozen", [150.0, 300.0]),
    ("cereals", "Pain", "BRD", "kg", [20.0, 50.0]),
    ("cereals", "Semoule", "SEM", "kg", [50.0, 120.0]),
    ("cereals", "Farine", "FLR", "kg", [40.0, 100.0]),
    ("cereals", "Riz", "RIC", "kg", [100.0, 250.0]),
    ("staples", "Huile végétale", "OIL", "liter", [180.0, 350.0]),
    ("staples", "Sucre", "SUG", "kg", [70.0, 150.0]),
    ("staples", "Lait", "MLK", "liter", [60.0, 100.0]),
    ("staples", "Beurre", "BUT", "kg", [600.0, 1200.0]),
]

# Map coordinates of the twenty regions on the board.
BOARD_REGIONS = [
    ("Alger", 36.74, 3.06), ("Oran", 35.70, -0.63), ("Constantine", 36.37, 6.61),
    ("Annaba", 36.90, 7.77), ("Tlemcen", 34.88, -1.32), ("Sétif", 36.18, 5.41),
    ("Batna", 35.56, 6.17), ("Tindouf", 27.67, -8.15), ("Blida", 36.47, 2.83),
    ("Ouargla", 31.95, 5.32), ("Ghardaïa", 32.49, 3.67), ("Tizi Ouzou", 36.72, 4.05),
    ("Béjaïa", 36.75, 5.06), ("Laghouat", 33.80, 2.86), ("Biskra", 34.85, 5.73),
    ("Tamanrasset", 22.79, 5.52), ("Médéa", 36.27, 2.75), ("Mostaganem", 35.93, 0.09),
    ("Skikda", 36.87, 6.91), ("Jijel", 36.82, 5.77),
]


def region_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        REGIONS, "region string, code string, latitude double, longitude double, province int"
    )


def product_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PRODUCTS,
        "category string, product string, code string, unit string, typical_price_range array<double>",
    )


def board_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOARD_REGIONS, "region string, latitude double, longitude double")


def with_typical_range(df: DataFrame, products: DataFrame) -> DataFrame:
    """Adds the product's ``typical_price_range`` and whether the price lies in it."""
    inside = F.col("price").between(F.get("typical_price_range", F.lit(0)), F.get("typical_price_range", F.lit(1)))
    ranges = products.select("product", "typical_price_range")
    return df.join(ranges, "product", "left").withColumn("in_range", inside)
