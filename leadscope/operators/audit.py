"""Date audits: component ranges of timestamps and well-formedness of date texts.

Both are one scan plus a partial aggregate: every row contributes its components (or its
date text) and is counted per distinct value before the shuffle, so the rule is evaluated
once per distinct value, not once per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.functions.dates import component_violation, is_date_text, parse_date_text

# The audited components and how each is read from a timestamp.
COMPONENTS = (("YY", F.year), ("MM", F.month), ("DD", F.dayofmonth),
              ("hh", F.hour), ("mm", F.minute), ("ss", F.second))


def date_component_audit(df: DataFrame, ts_col: str = "activity_ts") -> DataFrame:
    """Per (component, value): rows and the range violation message (NULL when valid)."""
    ts = F.col(ts_col)
    parts = F.array(*[F.struct(F.lit(code).alias("component"), fn(ts).alias("value")) for code, fn in COMPONENTS])
    counts = (df.select(F.inline(parts))
              .groupBy("component", "value")
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("message", component_violation(F.col("value"), F.col("component")))


def date_text_audit(df: DataFrame, text_col: str = "date_text") -> DataFrame:
    """Per distinct date text: rows, whether it is a real ``yyyy-MM-dd`` day, and that day."""
    counts = df.groupBy(F.col(text_col).alias("date_text")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("date_text", "n", is_date_text(F.col("date_text")).alias("is_valid"),
                         parse_date_text(F.col("date_text")).alias("day"))
