"""Schema drift between two states of a table, and contracts on what a table must look like."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyward.functions.frames import rows_from_aggregate

SNAPSHOT_SCHEMA = "table_name string, column_name string, data_type string, filled_rows bigint"


def schema_snapshot(df: DataFrame, table_name: str, columns_per_pass: int = 90) -> DataFrame:
    """(table_name, column_name, data_type, filled_rows): the schema, and how many rows use each column."""
    fields = df.schema.fields
    result = None
    for start in range(0, len(fields), columns_per_pass):
        part = rows_from_aggregate(
            df,
            [
                {
                    "table_name": F.lit(table_name),
                    "column_name": F.lit(field.name),
                    "data_type": F.lit(field.dataType.simpleString()),
                    "filled_rows": F.count(F.col(field.name)),
                }
                for field in fields[start : start + columns_per_pass]
            ],
        )
        result = part if result is None else result.unionByName(part)
    return result


def schema_only(spark: SparkSession, schema: StructType, table_name: str) -> DataFrame:
    """The same snapshot without counts: no data is read."""
    rows = [(table_name, field.name, field.dataType.simpleString(), None) for field in schema.fields]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns that differ between two snapshots: added, removed or type_changed, with the rows concerned."""
    paired = before.withColumnsRenamed({"data_type": "previous_type", "filled_rows": "previous_rows"}).join(
        after.withColumnsRenamed({"data_type": "current_type", "filled_rows": "current_rows"}),
        ["table_name", "column_name"],
        "full",
    )
    change = (
        F.when(F.col("previous_type").isNull(), "added")
        .when(F.col("current_type").isNull(), "removed")
        .when(F.col("previous_type") != F.col("current_type"), "type_changed")
    )
    return (
        paired.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select("table_name", "column_name", "change", "previous_type", "current_type", "previous_rows", "current_rows")
    )


# Types that hold every value of the narrower ones.
WIDER = {
    "bigint": ("tinyint", "smallint", "int"),
    "int": ("tinyint", "smallint"),
    "double": ("float", "tinyint", "smallint", "int"),
    "timestamp": ("date",),
}


def contract_status(schema: StructType, contract: Mapping[str, str]) -> dict[str, tuple[str | None, str | None, str]]:
    """Column name to (expected type, actual type, status); status is ``ok``, ``missing``, ``wrong_type`` or
    ``not_in_contract``. A type that the expected one holds without loss is ok. Looks at the schema only."""
    actual = {field.name: field.dataType.simpleString() for field in schema.fields}
    found = {}
    for name in [*contract, *[name for name in actual if name not in contract]]:
        if name not in actual:
            status = "missing"
        elif name not in contract:
            status = "not_in_contract"
        else:
            fits = actual[name] == contract[name] or actual[name] in WIDER.get(contract[name], ())
            status = "ok" if fits else "wrong_type"
        found[name] = (contract.get(name), actual.get(name), status)
    return found


def contract_breaches(schema: StructType, contract: Mapping[str, str]) -> list[str]:
    """Columns that are missing or of the wrong type. Further columns are no breach: the source has hundreds."""
    return [
        f"{name}: {status}"
        for name, (_, _, status) in contract_status(schema, contract).items()
        if status in ("missing", "wrong_type")
    ]


def contract_report(spark: SparkSession, schema: StructType, contract: Mapping[str, str], table_name: str) -> DataFrame:
    """Each column with its status: (table_name, column_name, expected_type, actual_type, status). No data is read."""
    rows = [(table_name, name, *status) for name, status in contract_status(schema, contract).items()]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, expected_type string, actual_type string, status string"
    )


def contract_usage(df: DataFrame, contract: Mapping[str, str], table_name: str) -> DataFrame:
    """(table_name, column_name, filled_rows): how many rows use each column of the contract. Reads those columns only."""
    present = [name for name in contract if name in df.columns]
    return schema_snapshot(df.select(*present), table_name).select("table_name", "column_name", "filled_rows")


def drift_status(columns: DataFrame, changes: DataFrame) -> DataFrame:
    """(column_name, change) for every column of either state, the change NULL where there is none."""
    return columns.select("column_name").join(changes.select("column_name", "change"), "column_name", "full")
