"""Insert-select by position into an existing table, with a report of rows that do not fit.

Columns are matched by their place, whatever their names.  The target's declared types come
from the catalog: CHAR(n) and VARCHAR(n) hold at most n characters besides trailing blanks,
other types take what can be cast.  Rows that fit go in; the others are reported with their
reasons instead of stopping the job or being cut.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .context import qualified


@dataclass(frozen=True)
class Target:
    name: str
    type: str  # as declared, e.g. char(30)
    nullable: bool

    @property
    def length(self) -> int | None:
        found = re.fullmatch(r"(?:var)?char\((\d+)\)", self.type)
        return int(found[1]) if found else None


def target_columns(spark: SparkSession, table: str) -> list[Target]:
    """The columns of a catalog table in order, with declared types."""
    nullable = {f.name: f.nullable for f in spark.table(table).schema.fields}
    out = []
    for row in spark.sql(f"DESCRIBE TABLE {table}").collect():
        if not row["col_name"] or row["col_name"].startswith("#"):
            break  # partition columns are listed again below
        out.append(Target(row["col_name"], row["data_type"], nullable[row["col_name"]]))
    return out


def _fitted(source: Column, kind: T.DataType, target: Target) -> tuple[Column, Column]:
    """(value for the target, reason why it does not fit or null)."""
    if target.length is not None:
        value = source.cast("string")
        over = F.length(F.rtrim(value)) > target.length
        reason = F.when(over, F.lit(f"{target.name}: longer than {target.length} characters"))
    else:
        value = source.try_cast(target.type)
        lost = value.isNull()
        if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) and target.type in ("tinyint", "smallint", "int", "bigint"):
            lost = lost | (value.cast("double") != source.cast("double"))  # no silent rounding
        reason = F.when(source.isNotNull() & lost, F.lit(f"{target.name}: not a value of type {target.type}"))
    if not target.nullable:
        reason = F.when(source.isNull(), F.lit(f"{target.name}: null")).otherwise(reason)
    return value, reason


@dataclass(frozen=True)
class InsertPlan:
    """``accepted`` has the target's columns; ``rejected`` the source's (c1, c2, ...) and ``reasons``."""

    table: str
    accepted: DataFrame
    rejected: DataFrame


def plan_insert(rows: DataFrame, table: str) -> InsertPlan:
    """Maps the columns of ``rows`` to those of ``table`` by position and checks every row."""
    spark = rows.sparkSession
    table = qualified(spark, table)
    targets = target_columns(spark, table)
    if len(targets) != len(rows.columns):
        raise ValueError(f"{table} has {len(targets)} columns, the rows have {len(rows.columns)}")
    kinds = [f.dataType for f in rows.schema.fields]
    places = [f"c{k + 1}" for k in range(len(targets))]
    source = rows.toDF(*places)
    fitted = [_fitted(F.col(c), kind, t) for c, kind, t in zip(places, kinds, targets)]
    reasons = F.array_compact(F.array(*[reason for _, reason in fitted]))
    checked = source.withColumn("reasons", reasons)
    fits = F.size("reasons") == 0
    values = [value.alias(t.name) for (value, _), t in zip(fitted, targets)]
    return InsertPlan(table, checked.filter(fits).select(*values), checked.filter(~fits))


def insert_by_position(rows: DataFrame, table: str, rejects: str | None = None, overwrite: bool = False) -> dict[str, int]:
    """Inserts the rows that fit; returns {reason: rows} of the others.

    ``rejects`` names a table that the others are appended to, as JSON with their reasons.
    ``rows`` is read twice, so it should be a table or a written stage.
    """
    plan = plan_insert(rows, table)
    if rejects:
        places = [c for c in plan.rejected.columns if c != "reasons"]
        said = plan.rejected.select(F.lit(plan.table).alias("target"), F.to_json(F.struct(*places)).alias("row"), "reasons")
        said.write.mode("append").format("parquet").saveAsTable(rejects)
    plan.accepted.write.insertInto(plan.table, overwrite=overwrite)
    counted = plan.rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").count()
    return {r["reason"]: r["count"] for r in counted.collect()}  # at most one line per column and kind
