"""Load job: CSV folder to clean Parquet tables with located zips."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession

from cartwise.operators.locations import clean_points, located_zips, with_geopoint
from cartwise.operators.quality import check_tables
from cartwise.operators.rows import delete_duplicates
from cartwise.schemas import ENTITIES
from cartwise.session import build_session, clear_scratch, materialise
from cartwise.sources.csv_files import read_folder
from cartwise.sources.tables import replace_table, scan_parquet, table_exists


#: Tables whose change moves a centroid or adds a zip.
LOCATED = ("geolocation", "customers", "sellers")


def load_folder(
    spark: SparkSession,
    folder: str,
    warehouse: str,
    file_name: str | None = None,
    rejects: dict[str, Observation] | None = None,
) -> dict[str, DataFrame]:
    """Read, clean and write every table of a folder; returns the written tables by name.

    Every file is loaded: files of one declared table together under its name, any other under its own.
    The order matters: points are cleaned before they are averaged, and zips that
    lost all their points come back without a position. Centroids are rebuilt whenever points, customers or sellers
    were loaded; what this load does not bring is taken from the warehouse. Tables that are
    read more than once are staged, so that each CSV is parsed once.
    """
    written: dict[str, DataFrame] = {}

    def path(name: str) -> str:
        return f"{warehouse.rstrip('/')}/{name}"

    def save(name: str, df: DataFrame) -> None:
        written[name] = replace_table(df, path(name))

    def known(name: str) -> DataFrame | None:
        if name in written:
            return written[name]
        return scan_parquet(spark, path(name)) if table_exists(spark, path(name)) else None

    for name, df in read_folder(spark, folder, file_name, rejects).items():
        if name == "order_reviews":
            df = delete_duplicates(materialise(df, name), ["review_id"])
        elif name == "geolocation":
            df = clean_points(materialise(df, name))
        save(name, df)
    points = known("geolocation") if any(n in written for n in LOCATED) else None
    if points is not None:
        save("geolocation_bis", with_geopoint(located_zips(points, known("customers"), known("sellers"))))
    return written


def main() -> None:
    parser = argparse.ArgumentParser(description="Load a folder of CSV files into Parquet tables")
    parser.add_argument("folder")
    parser.add_argument("warehouse")
    parser.add_argument("--file", help="only this file of the folder")
    args = parser.parse_args()
    spark = build_session("cartwise-load")
    rejects: dict[str, Observation] = {}
    tables = load_folder(spark, args.folder, args.warehouse, args.file, rejects)
    for name, counts in rejects.items():
        for column, n in counts.get.items():
            if n:
                print(f"{name}.{column}: {n} values could not be read")
    check_tables({n: t for n, t in tables.items() if n in ENTITIES}).where("violations > 0").show(truncate=False)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
