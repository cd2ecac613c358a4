"""Hand-built raw rows for the edge cases."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyward.sources.contract import RAW_CONTRACT

AS_OF = date(2021, 12, 31)
MARCH = date(2021, 3, 1)

RAW_SCHEMA = ", ".join(f"{name} {data_type}" for name, data_type in RAW_CONTRACT.items())


def raw_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw rows from the given cells; all others are NULL."""
    return spark.createDataFrame([tuple(row.get(name) for name in RAW_CONTRACT) for row in rows], RAW_SCHEMA)


def row(day: date | None, code: str | None, name: str | None, c: int | None = 1, d: int | None = 0, **cells) -> dict:
    return {"date": day, "country_code": code, "country_name": name, "new_confirmed": c, "new_deceased": d} | cells


def edge_rows(spark: SparkSession) -> DataFrame:
    return raw_rows(
        spark,
        row(MARCH, "AA", "Alpha", 10, 1, population=1000),
        row(MARCH, "AA", "Alpha", 30, 2, population=400, subregion1_name="S1"),
        row(MARCH, "BB", "Beta", 0, 0),
        row(MARCH, "CC", "Gamma", 2, 5),
        row(MARCH, "DD", "Delta", None, 1),
        row(date(2021, 3, 2), "DD", "Delta", 1, None),
        row(date(2021, 3, 3), "DD", "Delta", -5, 0),
        row(date(2021, 3, 3), "DD", "Delta", 5, -1),
        row(date(2019, 12, 31), "DD", "Delta"),
        row(date(2020, 1, 1), "DD", "Delta"),
        row(date(2021, 12, 31), "DD", "Delta"),
        row(date(2022, 1, 1), "DD", "Delta"),
        row(None, "DD", "Delta"),
        row(MARCH, None, "Nowhere"),
        row(MARCH, "EE", None),
        row(MARCH, "FF", "Phi", stringency_index=80.0, hospital_beds_per_1000=3.0),
        row(MARCH, "FF", "Phi"),
        row(
            MARCH,
            "GG",
            "Eta",
            current_hospitalized_patients=50,
            cumulative_confirmed=0,
            population=0,
            cumulative_persons_fully_vaccinated=10,
        ),
        row(MARCH, "HH", "Theta", cumulative_persons_fully_vaccinated=10),
        row(MARCH, "II", "Iota", current_hospitalized_patients=30, cumulative_confirmed=20),
        row(MARCH, "JJ", "Kappa", school_closing=1),
        row(MARCH, "JJ", "Kappa", school_closing=3),
        row(MARCH, "JJ", "Kappa"),
    )
