"""Declared types of the input tables and the snapshot."""

from __future__ import annotations

from pyspark.sql import types as T

QUANTITY = T.DecimalType(18, 4)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


SALES = _struct(
    ("invoice_id", T.StringType(), False),
    ("customer_id", T.LongType(), False),
    ("invoice_date", T.DateType(), False),
    ("product_id", T.LongType(), False),
    ("quantity", QUANTITY, False),
    ("revenue", QUANTITY, False),
    ("store_id", T.LongType(), True),
)

CUSTOMERS = _struct(
    ("customer_id", T.LongType(), False),
    ("customer_name", T.StringType(), True),
    ("customer_group", T.StringType(), True),
    ("city", T.StringType(), True),
    ("created_date", T.DateType(), True),
    ("email", T.StringType(), True),
    ("mobile_number", T.StringType(), True),
    ("opt_email", T.IntegerType(), True),
    ("opt_sms", T.IntegerType(), True),
    ("opt_phone", T.IntegerType(), True),
)

PRODUCTS = _struct(
    ("product_id", T.LongType(), False),
    ("product_name", T.StringType(), False),
    ("brand", T.StringType(), False),
    ("category", T.StringType(), False),
    ("unit_size", QUANTITY, True),
)

SNAPSHOT = _struct(
    ("report_mth_eom", T.DateType(), False),
    ("customer_id", T.LongType(), False),
    ("first_device_purchase_date", T.DateType(), True),
    ("first_consumable_purchase_date", T.DateType(), True),
    ("last_consumable_purchase_date", T.DateType(), True),
    ("tenure_months", T.IntegerType(), True),
    ("m_total", T.DoubleType(), False),
    ("m1", T.DoubleType(), False),
    ("m6", T.DoubleType(), False),
    ("m12", T.DoubleType(), False),
    ("m13", T.DoubleType(), False),
    ("m24", T.DoubleType(), False),
    ("m25", T.DoubleType(), False),
    ("o6", T.LongType(), False),
    ("avg_monthly_consumption", T.DoubleType(), False),
    ("avg_order_size", T.DoubleType(), True),
    ("activity_status", T.StringType(), False),
    ("value_tier", T.StringType(), True),
    ("lifecycle_event", T.StringType(), True),
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns as nullable strings, the form in which files land."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
