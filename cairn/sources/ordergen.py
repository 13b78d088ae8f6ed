"""Generated orders, bounded or as a stream, from expressions over a row number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Places (province, city, longitude, latitude) of the generator.
PLACES = (
    ("Beijing", "Beijing", 116.41, 39.90), ("Shanghai", "Shanghai", 121.47, 31.23), ("Guangdong", "Shenzhen", 114.06, 22.54),
    ("Guangdong", "Guangzhou", 113.26, 23.13), ("Zhejiang", "Hangzhou", 120.16, 30.27), ("Sichuan", "Chengdu", 104.07, 30.57),
)


def _draw(n: Column, salt: int, most: int) -> Column:
    return F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(most))


def orders(numbers: DataFrame, n: str = "id", time: Column | None = None) -> DataFrame:
    """Eleven order fields for each row number; the same number always gives the same order."""
    i = F.col(n)
    place = F.element_at(F.array(*[F.struct(F.lit(p).alias("prov"), F.lit(c).alias("city"), F.lit(x).alias("lon"), F.lit(y).alias("lat")) for p, c, x, y in PLACES]), (_draw(i, 1, len(PLACES)) + 1).cast("int"))
    user, item = _draw(i, 2, 100_000), _draw(i, 3, 10_000)
    return numbers.select(
        user.alias("user_id"), F.concat(F.lit("user_"), user.cast("string")).alias("user_name"), item.alias("item_id"), F.concat(F.lit("item_"), item.cast("string")).alias("item_name"),
        (_draw(i, 4, 1_000_000) / 100).cast("decimal(38,12)").alias("price"), place["prov"].alias("province"), place["city"].alias("city"),
        place["lon"].cast("string").alias("longitude"), place["lat"].cast("string").alias("latitude"),
        F.array_join(F.array(*[_draw(i, 10 + k, 256).cast("string") for k in range(4)]), ".").alias("ip"),
        (time if time is not None else F.timestamp_seconds(F.lit(1_700_000_000) + i)).alias("sale_timestamp"))


def bounded(spark: SparkSession, n: int) -> DataFrame:
    return orders(spark.range(n))


def stream(spark: SparkSession, per_second: int = 10) -> DataFrame:
    return orders(spark.readStream.format("rate").option("rowsPerSecond", per_second).load(), "value", F.col("timestamp"))
