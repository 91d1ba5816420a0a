"""Report sinks: tab-separated report folders and comma reports with one header line.

Executors write the files (one per partition) through Spark's commit protocol, so a
retried task never leaves half a report; the caller names the output folder.

Every text value comes back as it was: blanks are kept, empty text and NULL differ, and a value never
spans lines, so files stay splittable.  In text columns a backslash, tab, line feed and carriage return
are written as ``\\\\``, ``\\t``, ``\\n`` and ``\\r``; NULL is ``\\N``, which no written value can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Escaped characters, the mark of a missing value and that of a row equal to the header.
ESCAPES = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}
NULL_MARK = "\\N"
HEADER_MARK = "\\h"
_OPTIONS = {"nullValue": NULL_MARK, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _escaped(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for char, written in ESCAPES.items():
        c = F.replace(c, F.lit(char), F.lit(written))
    return c


def _plain(c: Column) -> Column:
    """Undo ``_escaped``: what lies between doubled backslashes holds single escapes only."""
    def part(x: Column) -> Column:
        for char, written in ESCAPES.items():
            x = F.replace(x, F.lit(written), F.lit(char))
        return x
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def _on_text(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_tsv(df: DataFrame, path: str) -> str:
    """Tab-separated lines, no header (the profile reports)."""
    _on_text(df, _escaped).write.mode("overwrite").options(**_OPTIONS, sep="\t", header=False).csv(path)
    return path


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _on_text(spark.read.schema(schema).options(**_OPTIONS, sep="\t", header=False).csv(path), _plain)


def _is_header(df: DataFrame, names: list[str]) -> Column:
    same = F.lit(True)
    for column, name in zip(df.columns, names):
        same = same & F.col(f"`{column}`").eqNullSafe(F.lit(name))
    return same


def write_csv_with_header(df: DataFrame, path: str, order: list[str] | None = None) -> str:
    """Comma-separated lines with one header line (the share study), in order of the columns ``order`` (default:
    all).  The parts are ranges of that order and are named by it: put one after the other, as
    ``report_parts`` lists them, they are the report."""
    names = df.columns
    texts = df.select(*[F.col(f"`{n}`").alias(f"_o{i}") for i, n in enumerate(order or names)],
                      *[F.col(f"`{n}`").cast("string").alias(f"_t{i}") for i, n in enumerate(names)])
    own = [_escaped(F.col(f"_t{i}")) if isinstance(f.dataType, StringType) else F.col(f"_t{i}")
           for i, f in enumerate(df.schema.fields)]
    lines = texts.select(F.lit(1).alias("_row"), *[c for c in texts.columns if c.startswith("_o")],
                         *[c.alias(f"_t{i}") for i, c in enumerate(own)])
    # a row of text that reads like the header is marked; backslashes are doubled, so no other row has the mark
    text_columns = [c for c in lines.columns if c.startswith("_t")]
    like_header = _is_header(lines.select(*text_columns), names)
    lines = lines.withColumn("_t0", F.when(like_header, F.concat(F.lit(HEADER_MARK), "_t0")).otherwise(F.col("_t0")))
    head = df.sparkSession.range(1).select(
        F.lit(0).alias("_row"), *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in lines.columns if c.startswith("_o")],
        *[F.lit(n).alias(f"_t{i}") for i, n in enumerate(names)])
    ordered = head.unionByName(lines).orderBy("_row", *[c for c in lines.columns if c.startswith("_o")])
    ordered.select(*text_columns).write.mode("overwrite").options(**_OPTIONS, header=False).csv(path)
    return path


def report_parts(spark: SparkSession, path: str) -> list[str]:
    """The files of a report, in the order in which they make it up."""
    return sorted(spark.read.text(path).inputFiles())


def read_csv_with_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    texts = spark.read.schema(", ".join(f"_t{i} string" for i in range(len(schema.fields)))).options(
        **_OPTIONS, header=False).csv(path)
    rows = texts.where(~_is_header(texts, schema.names))
    first = F.when(F.col("_t0").startswith(HEADER_MARK), F.substr("_t0", F.lit(len(HEADER_MARK) + 1))).otherwise(F.col("_t0"))
    plain = [first, *[F.col(f"_t{i}") for i in range(1, len(schema.fields))]]
    return rows.select(*[(_plain(c) if isinstance(f.dataType, StringType) else c.cast(f.dataType)).alias(f.name)
                         for c, f in zip(plain, schema.fields)])
