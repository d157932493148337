"""Order tables from header CSV, with declared or inferred schemas, and the schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "orders": (
        "Order_ID string, Customer_Trx_ID string, Order_Status string, "
        "Order_Purchase_Timestamp timestamp, Order_Approved_At timestamp, "
        "Order_Delivered_Carrier_Date timestamp, Order_Delivered_Customer_Date timestamp, "
        "Order_Estimated_Delivery_Date timestamp"
    ),
    "customers": (
        "Customer_Trx_ID string, Subscriber_ID string, Subscribe_Date date, "
        "First_Order_Date date, Customer_Postal_Code string, Customer_City string, "
        "Customer_Country string, Customer_Country_Code string, Age int, Gender string"
    ),
    "items": (
        "Order_ID string, Order_Item_ID int, Product_ID string, Seller_ID string, "
        "Shipping_Limit_Date timestamp, Price double, Freight_Value double"
    ),
    "reviews": (
        "Review_ID string, Order_ID string, Review_Score string, "
        "Review_Comment_Title_En string, Review_Comment_Message_En string, "
        "Review_Creation_Date string, Review_Answer_Timestamp timestamp"
    ),
    "products": (
        "Product_ID string, Product_Category_Name string, Product_Weight_Gr int, "
        "Product_Length_Cm int, Product_Height_Cm int, Product_Width_Cm int"
    ),
}


def read_table(spark: SparkSession, path: str, schema: str, sep: str = ";") -> DataFrame:
    """A header CSV with a declared schema: one pass, no inference."""
    return spark.read.options(header=True, sep=sep).schema(schema).csv(path)


def read_inferred(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """A header CSV whose types Spark infers in an extra distributed pass."""
    return spark.read.options(header=True, sep=sep, inferSchema=True).csv(path)


def schema_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``table, ordinal, column, type, nullable``: one row per column of every table."""
    rows = [
        (name, ordinal, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for ordinal, f in enumerate(df.schema.fields, start=1)
    ]
    schema = "table string, ordinal int, column string, type string, nullable boolean"
    return spark.createDataFrame(rows, schema)
