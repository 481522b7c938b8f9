"""One centroid per zip, with gaps filled for zips that have no point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.geo import geopoint, mercator_x, mercator_y
from cartwise.operators.rows import add_column_if_missing, append_missing, delete_duplicates, missing_rows, upsert
from cartwise.session import materialise

ZIP, LAT, LNG = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"


def clean_points(points: DataFrame) -> DataFrame:
    """Points whose (zip, lat, lng) is not repeated."""
    return delete_duplicates(points, [ZIP, LAT, LNG])


def centroids(points: DataFrame) -> DataFrame:
    """Mean position, greatest city and state name in binary order, and point count per zip."""
    return points.groupBy(ZIP).agg(
        F.avg(LAT).alias(LAT),
        F.avg(LNG).alias(LNG),
        F.max("geolocation_city").alias("geolocation_city"),
        F.max("geolocation_state").alias("geolocation_state"),
        F.count(F.lit(1)).cast("int").alias("n"),
    )


def fill_customer_zips(located: DataFrame, customers: DataFrame) -> DataFrame:
    """Add customer zips without a centroid, with no position and n = 0."""
    return append_missing(located, ZIP, customers.select("customer_zip_code_prefix"), n=0)


def upsert_seller_zips(located: DataFrame, sellers: DataFrame) -> DataFrame:
    """Add seller zips without a centroid; on a clash the new row wins."""
    return upsert(located, missing_rows(located, ZIP, sellers.select("seller_zip_code_prefix"), n=0), [ZIP])


def located_zips(points: DataFrame, customers: DataFrame | None, sellers: DataFrame | None) -> DataFrame:
    """The centroid table: cleaned points averaged, then customer and seller gaps filled.

    Each stage is small (one row per zip) and read twice by the next, so it is written.
    """
    located = centroids(points)
    if customers is not None:
        located = fill_customer_zips(materialise(located, "centroids"), customers)
    if sellers is not None:
        located = upsert_seller_zips(materialise(located, "customer-zips"), sellers)
    return located


def with_geopoint(located: DataFrame) -> DataFrame:
    """Set the point column from the coordinates; a row without coordinates keeps what it had."""
    dtype = "struct<x:double,y:double>"
    held = add_column_if_missing(located, "geopoint_location", dtype)
    point = geopoint(F.col(LAT), F.col(LNG)).cast(dtype)
    return held.withColumn("geopoint_location", F.coalesce(point, F.col("geopoint_location")))


def seller_locations(sellers: DataFrame, located: DataFrame) -> DataFrame:
    """Distinct seller zips with their position.

    Zips are made distinct before the join, so a zip shared by very many
    sellers joins once; the result is the same as DISTINCT after it.
    """
    zips = sellers.select("seller_zip_code_prefix").distinct()
    joined = zips.join(located, F.col("seller_zip_code_prefix") == F.col(ZIP))
    return joined.select("seller_zip_code_prefix", LAT, LNG).distinct()


def projected(df: DataFrame, spherical: bool = False) -> DataFrame:
    """Add Mercator metres to a table of centroids."""
    return df.withColumns(
        {"mercator_x": mercator_x(F.col(LNG)), "mercator_y": mercator_y(F.col(LAT), spherical=spherical)}
    )
