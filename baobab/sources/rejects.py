"""Reject channel: typed rows and quarantined lines of one text scan.

A typed CSV or JSON read turns what it cannot parse into NULL, which no later
step can tell from a value that was never there.  Here each line is read once,
parsed into strings, and every field cast tolerantly; a line that does not fit
keeps its raw text and the reasons, the others come out typed.

Lines are records: a quoted CSV field must not hold a line break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LINE, REASONS, _FIELDS, _CORRUPT = "ligne", "motifs", "_fields", "_corrupt"


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _checked(lines: DataFrame, parsed: Column, schema: StructType, required: Sequence[str], malformed: str) -> DataFrame:
    """Adds the parsed fields as strings and the reasons against a line, in column order."""
    raw = lines.withColumn(_FIELDS, parsed)
    broken = F.col(_FIELDS).isNull() | F.col(f"{_FIELDS}.{_CORRUPT}").isNotNull()
    against = []
    for f in schema:
        value = F.col(f"{_FIELDS}.{f.name}")
        against.append(F.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f"type:{f.name}")))
        if f.name in required:
            against.append(F.when(value.isNull(), F.lit(f"missing:{f.name}")))
    reasons = F.when(broken, F.array(F.lit(malformed))).otherwise(F.array_compact(F.array(*against)))
    return raw.withColumn(REASONS, reasons)


def check_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    required: Sequence[str] = (),
    header: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Lines of a CSV folder with their fields and the reasons against them.

    ``header``: the header line to be left out, wherever a file repeats it; by
    default the column names joined by ``sep``.  A line of another number of
    fields is `fields`; a value that is not of its column's type `type:<column>`;
    an empty value of a ``required`` column `missing:<column>`.  Empty lines are
    left out, as by the CSV reader."""
    schema = _struct(schema)
    header = sep.join(schema.names) if header is None else header
    lines = spark.read.text(path).withColumnRenamed("value", LINE).filter((F.col(LINE) != header) & (F.trim(LINE) != ""))
    strings = ", ".join(f"`{n}` string" for n in [*schema.names, _CORRUPT])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return _checked(lines, F.from_csv(F.col(LINE), strings, options), schema, required, "fields")


def check_json(spark: SparkSession, path: str, schema: StructType | str, required: Sequence[str] = ()) -> DataFrame:
    """The same for JSON Lines; a line that is no JSON object is `json`.

    Fields are parsed as strings, so a number in quotes is a number."""
    schema = _struct(schema)
    lines = spark.read.text(path).withColumnRenamed("value", LINE).filter(F.trim(LINE) != "")
    strings = ", ".join(f"`{n}` string" for n in [*schema.names, _CORRUPT])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return _checked(lines, F.from_json(F.col(LINE), strings, options), schema, required, "json")


def accepted(checked: DataFrame, schema: StructType | str) -> DataFrame:
    """The lines that nothing speaks against, as typed rows."""
    values = [F.col(f"{_FIELDS}.{f.name}").try_cast(f.dataType).alias(f.name) for f in _struct(schema)]
    return checked.filter(F.size(REASONS) == 0).select(*values)


def rejected(checked: DataFrame) -> DataFrame:
    """The quarantine: raw line and reasons."""
    return checked.filter(F.size(REASONS) > 0).select(LINE, F.array_join(REASONS, " ").alias(REASONS))


def reject_report(checked: DataFrame) -> DataFrame:
    """Lines per reason, the accepted ones as `ok`; a line with several reasons counts under each."""
    each = F.explode(F.when(F.size(REASONS) == 0, F.array(F.lit("ok"))).otherwise(F.col(REASONS)))
    return checked.select(each.alias("motif")).groupBy("motif").agg(F.count("*").alias("n"))
