"""Explicit schemas of the raw tables; CSV is never read with inferred types."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


STORES = _schema(
    "store_id string, store_name string, brand_id string, country string, location_type string, "
    "store_size_sqm int, tier string, history_days int, opening_date date, is_ecommerce boolean"
)
BRANDS = _schema(
    "brand_id string, brand_name string, category string, price_tier string, "
    "avg_price_point int, seasonality_strength double"
)
SALES = _schema(
    "date date, store_id string, brand_id string, country string, sales_amount double, "
    "num_transactions int, avg_transaction_value double, promotion_flag int, "
    "promotion_discount double, day_of_week int, is_weekend int, month int, year int"
)
EXTERNAL = _schema(
    "date date, country string, gdp_growth double, tourism_index double, "
    "currency_rate_to_usd double, temperature_celsius double, is_public_holiday int"
)
FORECASTS = _schema(
    "date date, store_id string, brand_id string, country string, predicted_sales double, "
    "lower_bound double, upper_bound double, confidence_level double, prediction_type string"
)
STORE_HEALTH = _schema(
    "store_id string, num_days bigint, mape double, mae double, avg_actual double, "
    "avg_predicted double, health_status string"
)

RAW_TABLES = {"stores": STORES, "brands": BRANDS, "sales": SALES, "external": EXTERNAL}


def with_types(schema: T.StructType, **types: str) -> T.StructType:
    """The same schema with some column types replaced (``store_id='bigint'``)."""
    return T.StructType(
        [
            T.StructField(f.name, TYPES[types[f.name]] if f.name in types else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )
