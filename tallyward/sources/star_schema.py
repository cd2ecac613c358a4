"""Raw daily observations derived from a star schema (line items, suppliers, nations).

One raw row per line item. The expressions are written so that Spark SQL and an ANSI database read them alike,
which lets a second engine check every query from the same input. ``k`` numbers the line items; remainders of
``k`` decide which cells are missing or invalid, so that every filter and every NULL rule meets real cases.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_DAY = date(2020, 12, 31)

ROW_NUMBER = "l_orderkey * 7 + l_linenumber"


def _some(every: int, value: str) -> str:
    """``value`` as a bigint, missing in every ``every``-th row."""
    return f"case when k % {every} = 0 then null else cast({value} as bigint) end"


RAW_EXPRESSIONS = {
    "date": "case when k % 211 = 0 then null"
    " else date '2019-12-01' + cast((l_orderkey + l_linenumber) % 400 as int) end",
    "country_code": "case when n_nationkey = 24 then null"
    " else substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', n_nationkey + 1, 1)"
    " || substr('NOPQRSTUVWXYZABCDEFGHIJKLM', n_nationkey + 1, 1) end",
    "country_name": "n_name",
    "subregion1_name": "case when l_linenumber = 1 then null else 'S' || cast(l_linenumber as varchar(2)) end",
    "new_confirmed": "case when k % 89 = 0 then null when k % 97 = 0 then -1 when k % 3 = 0 then 0"
    " else cast(l_quantity as bigint) end",
    "new_deceased": "case when k % 83 = 0 then null when k % 101 = 0 then -1 else l_partkey % 8 end",
    "new_recovered": _some(5, "l_partkey % 40"),
    "cumulative_confirmed": _some(7, "l_partkey * 3"),
    "cumulative_deceased": _some(7, "l_partkey % 300"),
    "new_hospitalized_patients": _some(4, "l_suppkey % 20"),
    "current_hospitalized_patients": _some(4, "l_partkey % 900"),
    "new_intensive_care_patients": _some(4, "l_partkey % 9"),
    "current_intensive_care_patients": _some(4, "l_partkey % 90"),
    "current_ventilator_patients": _some(4, "l_partkey % 45"),
    "hospital_beds_per_1000": "case when k % 6 = 0 then null else cast(l_partkey % 40 as double) / 4 end",
    "new_persons_vaccinated": _some(3, "l_partkey % 500"),
    "cumulative_persons_vaccinated": _some(3, "l_partkey * 20"),
    "new_persons_fully_vaccinated": _some(3, "l_partkey % 400"),
    "cumulative_persons_fully_vaccinated": _some(3, "l_partkey * 15"),
    "new_vaccine_doses_administered": _some(3, "l_partkey % 900"),
    "cumulative_vaccine_doses_administered": _some(3, "l_partkey * 35"),
    "new_vaccine_doses_administered_pfizer": _some(5, "l_partkey % 450"),
    "new_vaccine_doses_administered_moderna": _some(6, "l_partkey % 300"),
    "new_vaccine_doses_administered_janssen": _some(7, "l_partkey % 150"),
    "school_closing": _some(9, "l_partkey % 4"),
    "workplace_closing": _some(9, "l_suppkey % 4"),
    "cancel_public_events": _some(9, "l_partkey % 3"),
    "restrictions_on_gatherings": _some(9, "l_partkey % 5"),
    "stay_at_home_requirements": _some(9, "l_orderkey % 4"),
    "international_travel_controls": _some(9, "l_orderkey % 5"),
    "stringency_index": "case when k % 9 = 0 then null else cast(l_partkey % 201 as double) / 2 end",
    "population": "case when k % 10 = 0 then null when n_nationkey = 7 then 0"
    " else cast((n_nationkey + 1) * 99991 as bigint) end",
    "gdp_per_capita_usd": "case when k % 10 = 0 then null else cast((n_nationkey + 1) * 1500 as bigint) end",
    "human_development_index": "case when k % 10 = 0 then null else cast(n_nationkey + 32 as double) / 64 end",
}


def raw_observations(spark: SparkSession, directory: str, *more: str) -> DataFrame:
    """The raw table over every line item in ``directory``, with ``more`` columns of the line items (``k`` numbers them).

    The joins are left-deep, so that each dimension keeps the size estimate of its own files: Spark broadcasts
    it while it is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, splitting hot keys
    at run time. Nothing is broadcast by hint, as suppliers grow with the data.
    """
    items = spark.read.parquet(f"{directory}/lineitem.parquet")
    suppliers = spark.read.parquet(f"{directory}/supplier.parquet")
    nations = spark.read.parquet(f"{directory}/nation.parquet")
    joined = (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("k", F.expr(ROW_NUMBER))
    )
    return joined.selectExpr(*[f"{text} as {name}" for name, text in RAW_EXPRESSIONS.items()], *more)
