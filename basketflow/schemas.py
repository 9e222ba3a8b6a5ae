"""Column names and table schemas."""

from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

CUST = "CUST_CODE"
BASKET = "BASKET_ID"
PROD = "PROD_CODE"
WEEK = "SHOP_WEEK"

UNKNOWN_ITEM = "UNK"  # vocabulary entry 0
PAD = 0  # index 0 stands for both an unknown item and padding

# The staged transaction table has these 22 nullable columns, in this order.
TRANSACTIONS_COLUMNS = {
    "SHOP_WEEK": "int",
    "SHOP_DATE": "int",
    "SHOP_WEEKDAY": "int",
    "SHOP_HOUR": "int",
    "QUANTITY": "int",
    "SPEND": "float",
    "PROD_CODE": "string",
    "PROD_CODE_10": "string",
    "PROD_CODE_20": "string",
    "PROD_CODE_30": "string",
    "PROD_CODE_40": "string",
    "CUST_CODE": "string",
    "CUST_PRICE_SENSITIVITY": "string",
    "CUST_LIFESTAGE": "string",
    "BASKET_ID": "string",
    "BASKET_SIZE": "string",
    "BASKET_PRICE_SENSITIVITY": "string",
    "BASKET_TYPE": "string",
    "BASKET_DOMINANT_MISSION": "string",
    "STORE_CODE": "string",
    "STORE_FORMAT": "string",
    "STORE_REGION": "string",
}

# The calendar table.
CALENDAR_COLUMNS = {"SHOP_WEEK": "int", "DATE_FROM": "int", "DATE_TO": "int"}

_TYPES = {"int": IntegerType(), "float": FloatType(), "string": StringType()}


def _schema(columns: dict[str, str]) -> StructType:
    return StructType([StructField(name, _TYPES[kind]) for name, kind in columns.items()])


TRANSACTIONS_SCHEMA = _schema(TRANSACTIONS_COLUMNS)
CALENDAR_SCHEMA = _schema(CALENDAR_COLUMNS)
