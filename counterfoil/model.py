"""The point-of-sale data model: table schemas and the bundle of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PRICE = T.DecimalType(6, 2)
RATE = T.DecimalType(6, 5)
# Totals are kept wider than the single prices so that sums over many lines fit.
MONEY = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _LONG, _INT, _DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DateType()

PRODUCT = _schema(id=_LONG, name=_TEXT, currentPrice=PRICE, availableQuantity=_INT)
CITY = _schema(zip=_TEXT, city=_TEXT, state=_TEXT)
CUSTOMER = _schema(
    id=_LONG, firstName=_TEXT, lastName=_TEXT, email=_TEXT, address1=_TEXT,
    address2=_TEXT, birthdate=_DATE, zip=_TEXT,
)
ORDER = _schema(
    id=_LONG, datePlaced=_DATE, dateShipped=_DATE, customer_id=_LONG, subtotal=MONEY, salesTax=MONEY,
)
ORDERLINE = _schema(order_id=_LONG, product_id=_LONG, quantity=_INT, unitPrice=PRICE)
PRICE_HISTORY = _schema(
    product_id=_LONG, oldPrice=PRICE, newPrice=PRICE, ts=T.TimestampType(), seq=_LONG,
)
SALES_TAX = _schema(
    zip=_TEXT, state=_TEXT, taxRegionName=_TEXT, estimatedCombinedRate=RATE, stateRate=RATE,
    estimatedCountyRate=RATE, estimatedCityRate=RATE, estimatedSpecialRate=RATE, riskLevel=_INT,
)
LINE_CHANGE = _schema(
    op=_TEXT, seq=_LONG, order_id=_LONG, product_id=_LONG, quantity=_INT,
    new_order_id=_LONG, new_product_id=_LONG,
)
#: One feed of both: ``op`` is that of a line change, or price.
EVENT = _schema(
    op=_TEXT, seq=_LONG, order_id=_LONG, product_id=_LONG, quantity=_INT,
    new_order_id=_LONG, new_product_id=_LONG, price=PRICE, ts=T.TimestampType(),
)
PRICE_CHANGE = _schema(product_id=_LONG, price=PRICE, ts=T.TimestampType(), seq=_LONG)

# Declared text lengths, checked by quality.length_violations.
TEXT_LENGTHS = {
    "product": {"name": 128},
    "city": {"city": 32, "state": 4},
    "customer": {"firstName": 32, "lastName": 30, "email": 128, "address1": 100, "address2": 50},
    "sales_tax": {"state": 2, "taxRegionName": 64},
}


@dataclass(frozen=True)
class Pos:
    """The seven tables of one shop; every operator takes and returns these lazily."""

    products: DataFrame
    cities: DataFrame
    customers: DataFrame
    orders: DataFrame
    lines: DataFrame
    price_history: DataFrame
    tax_rates: DataFrame

    def with_(self, **tables: DataFrame) -> "Pos":
        return replace(self, **tables)
