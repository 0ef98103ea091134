"""Explicit schemas of the tables the recipes read."""

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()
_D, _B, _TS = T.DateType(), T.BooleanType(), T.TimestampNTZType()
_MONEY = T.DecimalType(10, 2)


def _table(*columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# Time of day is read as text HH:mm:ss; `second_of_day` columns hold it as a number.
SALES_LINES = _table(
    ("transaction_id", _S), ("customer_id", _S), ("sale_date", _D), ("sale_time", _S),
    ("day_of_week", _I), ("day_name", _S), ("is_weekend", _B), ("coffee_name", _S),
    ("drink_price", _MONEY), ("total_cost", _MONEY), ("payment_method", _S),
    ("datetime", _TS), ("time_of_day", _S),
)
# The older variant has no day part; see tables.add_time_of_day.
SALES_LINES_V1 = T.StructType([f for f in SALES_LINES.fields if f.name != "time_of_day"])
DIM_COFFEE = _table(("coffee_id", _I), ("coffee_name", _S), ("base_weight", T.DoubleType()))
DRINK_PRICE_REF = _table(("coffee_name", _S), ("standard_price", _I))
FACT_SALES_Q3 = _table(
    ("date_key", _I), ("hour_of_day", T.ShortType()), ("time_of_day", _S), ("cash_type", _S),
    ("coffee_name", _S), ("cost", _MONEY), ("sale_time", _S),
)
PRODUCT_SALES = _table(
    ("sale_id", _L), ("product_id", _L), ("sale_date", _TS), ("quantity", _MONEY), ("customer_id", _L)
)
PRODUCTS = _table(
    ("product_id", _L), ("model_name", _S), ("category", _S), ("cost_price", _MONEY), ("sale_price", _MONEY)
)
INVENTORY_LOG = _table(("product_id", _L), ("date", _D), ("stock_on_hand", _I), ("operation_type", _S))
RETURN_ORDERS = _table(("order_id", _L), ("category", _S), ("brand", _S), ("status", _S), ("order_date", _D))
FULFILMENT = _table(("order_id", _L), ("darkstore_id", _L), ("created_at", _TS), ("assembled_at", _TS))
DARKSTORES = _table(("darkstore_id", _L), ("city_name", _S))
LTV_ORDERS = _table(
    ("user_id", _L), ("order_date", _D), ("product_id", _L), ("amount", _MONEY), ("quantity", _MONEY)
)
LTV_PRODUCTS = _table(("id", _L), ("unit_cost", _MONEY))
SKU_CATALOG = _table(("sku", _L), ("item_name", _S))
WMS_INVENTORY = _table(("sku", _L), ("system_qty", _I), ("purchase_price", _MONEY))
SCANNER_SCANS = _table(("sku", _L), ("qty", _MONEY))
FALLING_DEMAND = _table(
    ("product_id", _L), ("category", _S), ("model_name", _S), ("sale_date", _D),
    ("daily_sales", T.DoubleType()), ("diff", T.DoubleType()), ("moving_avg_7d", T.DoubleType()),
)
