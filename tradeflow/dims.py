"""Dimension tables of the trade-statistics domain.

The small code lists below are fixed values that published outputs depend on.
The partner -> continent / sub-region tables (about 240 names each) are not
shipped: callers pass them as a DataFrame ``(partner, partner_continent,
partner_sub_region)``, e.g. read from their own reference CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest dimension built from Python rows (shipped whole to every task).
MAX_INLINE_ROWS = 10_000

# General categories kept in the published table.
FINAL_GENERAL_CATEGORIES = ("PCR", "TBR", "Specialty")

# Reporter labels that are not countries.
INVALID_REPORTERS = (
    "Special value",
    ":",
    "European Union - 27 countries",
)

# Partner labels that are aggregates, not countries.
EXCLUDED_PARTNERS = (
    "All countries of the world",
    "Extra-EU27",
    "Intra-EU27",
    "Stores and provisions",
    "Stores and provisions within the framework of intra-Union trade",
    "Stores and provisions within the framework of extra-Union trade",
    "Countries and territories not specified",
    "Countries and territories not specified within the framework of intra-Union trade",
    "Countries and territories not specified within the framework of extra-Union trade",
    "Countries and territories not specified for commercial or military reasons",
    "Countries and territories not specified for commercial or military reasons in the framework of intra-Union trade",
    "Countries and territories not specified for commercial or military reasons in the framework of extra-Union trade",
)

# Tyre product label -> (HS code, category).
TYRE_PRODUCTS = (
    ("New pneumatic tyres, of rubber", "4011", "All"),
    ("New pneumatic tyres, of rubber, of a kind used for motor cars, incl. station wagons and racing cars",
     "401110", "PCR"),
    ("New pneumatic tyres, of rubber, of a kind used for buses and lorries (excl. tyres with lug, corner or "
     "similar treads)", "401120", "LT&TBR"),
    ("Pneumatic tyres, new, of rubber, of a kind used for buses or lorries, with a load index of <= 121",
     "40112010", "LT"),
    ("Pneumatic tyres, new, of rubber, of a kind used for buses or lorries, with a load index of > 121",
     "40112090", "TBR"),
    ("New pneumatic tyres, of rubber, of a kind used on agricultural or forestry vehicles and machines",
     "401170", "ARG & FOR"),
    ("New pneumatic tyres, of rubber, of a kind used on construction, mining or industrial handling vehicles "
     "and machines", "401180", "GC & Mining & MH"),
)

# Tyre category -> general category.
TYRE_CATEGORY_GENERAL = (
    ("PCR", "PCR"),
    ("LT", "PCR"),
    ("TBR", "TBR"),
    ("LT&TBR", "LT&TBR"),
    ("ARG & FOR", "Specialty"),
    ("GC & Mining & MH", "Specialty"),
    ("All", "All"),
)

# Vehicle product label -> HS code.
VEHICLE_PRODUCTS = (
    ("Tractors (other than tractors of heading 8709)", "8701"),
    ("Motor vehicles for the transport of >= 10 persons, incl. driver", "8702"),
    ("Motor cars and other motor vehicles principally designed for the transport of <10 persons, incl. station "
     "wagons and racing cars (excl. motor vehicles of heading 8702)", "8703"),
    ("Motor vehicles for the transport of goods, incl. chassis with engine and cab", "8704"),
    ("Special purpose motor vehicles (other than those principally designed for the transport of persons or "
     "goods), e.g. breakdown lorries, crane lorries, fire fighting vehicles, concrete-mixer lorries, road "
     "sweeper lorries, spraying lorries, mobile workshops and mobile radiological units", "8705"),
    ("Chassis fitted with engines, for tractors, motor vehicles for the transport of ten or more persons, motor "
     "cars and other motor vehicles principally designed for the transport of persons, motor vehicles for the "
     "transport of goods and special purpose motor vehicles of heading 8701 to 8705 (excl. those with engines "
     "and cabs)", "8706"),
    ("Works trucks, self-propelled, not fitted with lifting or handling equipment, of the type used in "
     "factories, warehouses, dock areas or airports for short distance transport of goods; tractors of the "
     "type used on railway station platforms; parts of the foregoing vehicles, n.e.s.", "8709"),
    ("Trailers and semi-trailers; other vehicles, not mechanically propelled (excl. railway and tramway "
     "vehicles); parts thereof, n.e.s.", "8716"),
    ("Trailers and semi-trailers of the caravan type, for housing or camping", "871610"),
    ("Self-loading or self-unloading trailers and semi-trailers for agricultural purposes", "871620"),
    ("Tanker trailers and tanker semi-trailers, not designed for running on rails", "871631"),
    ("Trailers and semi-trailers for the transport of goods, not designed for running on rails (excl. "
     "self-loading or self-unloading trailers and semi-trailers for agricultural purposes and tanker trailers "
     "and tanker semi-trailers)", "871639"),
    ("Trailers and semi-trailers, not designed for running on rails (excl. trailers and semi-trailers for the "
     "transport of goods and those of the caravan type for housing or camping)", "871640"),
    ("Vehicles pushed or drawn by hand and other vehicles not mechanically propelled (excl. trailers and "
     "semi-trailers)", "871680"),
    ("Electrical vehicles not fitted with lifting or handling equipment, of the type used in factories, "
     "warehouses, dock areas or airports for short distance transport of goods; tractors of the type used on "
     "railway station platforms", "870911"),
    ("Works trucks, self-propelled, not fitted with lifting or handling equipment, of the type used in "
     "factories, warehouses, dock areas or airports for short distance transport of goods; tractors of the "
     "type used on railway station platforms (excl. electrical trucks)", "870919"),
    ("Parts of self-propelled works trucks, not fitted with lifting or handling equipment, of the type used in "
     "factories, warehouses, dock areas or airports for short distance transport of goods, incl. tractors for "
     "railways station platforms, n.e.s.", "870990"),
)

# Vehicle HS headings dropped before categorising.
VEHICLE_EXCLUDED_HS = ("8709", "8716", "8706")

# Vehicle HS code -> general category.
VEHICLE_HS_GENERAL = (
    ("8701", "Specialty"),
    ("8702", "TBR"),
    ("8703", "PCR"),
    ("8704", "TBR"),
    ("8705", "Specialty"),
    ("870911", "Specialty"),
    ("870919", "Specialty"),
    ("871610", "Other"),
    ("871620", "Specialty"),
    ("871631", "TBR"),
    ("871639", "TBR"),
    ("871640", "TBR"),
    ("871680", "Other"),
)

# Vehicle codes not requested from the cube source.
VEHICLE_CUBE_EXCLUDED = ("871610", "871680")

# Indicator alias -> cube indicator code and measure column.
INDICATORS = (
    ("value", "VALUE_IN_EUROS", "value"),
    ("weight", "QUANTITY_IN_100KG", "weight"),
)

# Fixed value: weight is reported in units of 100 kg.
WEIGHT_FACTOR = 100

# Fixed value: first month of the published table.
PUBLISH_FLOOR = "2017-01-01"


def small_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A dimension from Python rows, marked for broadcast.

    A DataFrame built from a Python list carries no size statistics, so Spark
    would shuffle-join it; its row count is known here. Up to MAX_INLINE_ROWS
    rows that makes the broadcast safe; a larger one joins by a shuffle.
    """
    rows = list(rows)
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= MAX_INLINE_ROWS else table


def values_df(spark: SparkSession, column: str, values) -> DataFrame:
    """One-column string dimension from a list of values."""
    return small_table(spark, [(v,) for v in values], f"`{column}` string")


def tyre_product_dim(spark: SparkSession) -> DataFrame:
    """``(product, hs_code, category)``."""
    return small_table(spark, TYRE_PRODUCTS, "product string, hs_code string, category string")


def tyre_category_dim(spark: SparkSession) -> DataFrame:
    """``(category, general_category)``."""
    return small_table(spark, TYRE_CATEGORY_GENERAL, "category string, general_category string")


def vehicle_product_dim(spark: SparkSession) -> DataFrame:
    """``(product, hs_code)``."""
    return small_table(spark, VEHICLE_PRODUCTS, "product string, hs_code string")


def vehicle_general_dim(spark: SparkSession) -> DataFrame:
    """``(hs_code, general_category)``."""
    return small_table(spark, VEHICLE_HS_GENERAL, "hs_code string, general_category string")


def indicator_dim(spark: SparkSession) -> DataFrame:
    """``(indicator_alias, indicator_code, measure)``."""
    return small_table(spark, INDICATORS, "indicator_alias string, indicator_code string, measure string")
