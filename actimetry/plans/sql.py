"""The dashboard statements as parameterised Spark SQL (same plans as the DataFrame forms).

The DAU frame is passed as a relation argument and the date as a bound named
parameter, so no text is spliced into the statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAU_TOTAL = "SELECT count(*) AS dau FROM {dau} WHERE log_date = :d"
DAU_HOURS = "SELECT log_hour AS lh, count(*) AS ct FROM {dau} WHERE log_date = :d GROUP BY log_hour"
GMV_TOTAL = ("SELECT sum(CAST(round(amount * 100) AS BIGINT)) / 100.0D AS gmv "
             "FROM {orders} WHERE create_date = :d")
GMV_HOURS = ("SELECT create_hour, sum(CAST(round(amount * 100) AS BIGINT)) / 100.0D AS sum_amount "
             "FROM {orders} WHERE create_date = :d GROUP BY create_hour")


def dau_total_sql(spark: SparkSession, dau: DataFrame, date: str) -> DataFrame:
    return spark.sql(DAU_TOTAL, args={"d": date}, dau=dau)


def dau_hours_sql(spark: SparkSession, dau: DataFrame, date: str) -> DataFrame:
    return spark.sql(DAU_HOURS, args={"d": date}, dau=dau)


def gmv_total_sql(spark: SparkSession, orders: DataFrame, date: str) -> DataFrame:
    return spark.sql(GMV_TOTAL, args={"d": date}, orders=orders)


def gmv_hours_sql(spark: SparkSession, orders: DataFrame, date: str) -> DataFrame:
    return spark.sql(GMV_HOURS, args={"d": date}, orders=orders)
