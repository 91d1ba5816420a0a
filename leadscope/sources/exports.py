"""Scans of the raw delimited exports: activity (``,``), accounts and monthly extract (``;``).

Each parser takes a DataFrame with a text column (default ``line``) – from ``read_lines``
or any other source – keeps every other column (record ids, file names) and adds the
typed fields plus ``reject_reason``: NULL for a good row, otherwise why it is unusable.
``good`` / ``rejects`` split that one frame, so no row is dropped silently; ``keep_line``
keeps the raw text next to the fields (for reject tables).  Splitting is
positional with Spark's ``split(.., -1)``, which keeps trailing empty fields.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadscope.functions.numeric import to_long, tolerant_double
from leadscope.functions.text import clean_text, java_trim

# Field positions (0-based) of the comma-separated activity export.
ACTIVITY_POSITIONS = {
    "account_key": 2, "date": 3, "heading_id": 4, "directory_id": 5, "referer_id": 7,
    "impression_weight": 12, "click_weight": 13, "is_mobile": 15, "keywords": 17,
}
ACTIVITY_MIN_FIELDS = 18

# Field positions of the semicolon-separated account export, and the
# verticals that are kept (after trim, upper-case and removing double quotes).
ACCOUNT_POSITIONS = {"account_key": 0, "account_id": 2, "account_name": 3, "vertical": 4}
ACCOUNT_MIN_FIELDS = 5
KEPT_VERTICALS = ("MERCHANT", "", "CLIENT")

# Field positions of the semicolon-separated monthly extract.
EXTRACT_POSITIONS = {"account_key": 0, "directory_id": 5, "impressions": 12, "clicks": 13}
EXTRACT_MIN_FIELDS = 14

# Source file name prefixes of the two activity channels.
CHANNEL_FILE_PREFIXES = {"online": "deduped-", "mobile": "API_DTA_D_"}

SHORT_ROW = "short_row"
BAD_NUMBER = "bad_number"
OTHER_VERTICAL = "other_vertical"


# Suffixes of compressed text that Spark reads as one split a file.
ONE_SPLIT_SUFFIXES = (".gz", ".deflate", ".snappy", ".lz4", ".zst")
DEFAULT_WHOLE_BYTES = 32 << 20


def read_lines(spark: SparkSession, paths: str | list[str], whole_bytes: int = DEFAULT_WHOLE_BYTES,
               parts: int | None = None) -> DataFrame:
    """Text files (plain or compressed) -> (line, source_file).

    A compressed file that cannot be split is decompressed by one task.  The lines of those with more than
    ``whole_bytes`` bytes are dealt out before anything parses them: by their place in the file, so a retried
    task sends each line where it went before and repeated lines do not meet.  AQE sizes the parts unless
    ``parts`` names their number.  Each file is in one of the two scans: the conditions are on file metadata,
    which Spark tests against the file listing."""
    files = spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"),
                                          F.col("_metadata.file_size").alias("_size"))
    whole = reduce(operator.or_, [F.lower("source_file").endswith(s) for s in ONE_SPLIT_SUFFIXES]) & (F.col("_size") > whole_bytes)
    columns = ["line", "source_file"]
    placed = files.where(whole).select(*columns, F.monotonically_increasing_id().alias("_at"))
    dealt = placed.repartition("_at") if parts is None else placed.repartition(parts, "_at")
    return files.where(~whole).select(*columns).unionAll(dealt.select(*columns))


EXPORT_NAME_PATTERN = ("(" + "|".join(re.escape(p) for p in CHANNEL_FILE_PREFIXES.values()) + ")"
                       + r"([0-9]{4}-[0-9]{2}-[0-9]{2})")


def channel_of_file(path: Column) -> Column:
    """Channel of an activity export from the export name (prefix + day) in its path –
    the file name or a folder – NULL for other files."""
    prefix = F.regexp_extract(path, EXPORT_NAME_PATTERN, 1)
    out = F.lit(None).cast("string")
    for channel, p in CHANNEL_FILE_PREFIXES.items():
        out = F.when(prefix == p, F.lit(channel)).otherwise(out)
    return out


def day_of_file(path: Column) -> Column:
    """Day of an activity export from the export name in its path."""
    return F.try_to_date(F.regexp_extract(path, EXPORT_NAME_PATTERN, 2), "yyyy-MM-dd")


def _field(parts: Column, pos: int) -> Column:
    return F.get(parts, pos)


def split_quoted(line: Column, sep: str) -> Column:
    """Fields of a line; a separator with an odd number of double quotes after it belongs to its field.

    One pass over the quoted sections: a line holds no line feed, so that stands in for the separators
    inside them while the line is split."""
    from_end = F.reverse(F.split(line, '"', -1))
    shielded = F.transform(from_end, lambda s, i: F.when(i % 2 == 1, F.replace(s, F.lit(sep), F.lit("\n"))).otherwise(s))
    fields = F.split(F.array_join(F.reverse(shielded), '"'), sep, -1)
    return F.transform(fields, lambda f: F.replace(f, F.lit("\n"), F.lit(sep)))


def _parse(lines: DataFrame, line_col: str, sep: str, keep_line: bool, fields: dict, build, quoted: bool = False
           ) -> DataFrame:
    """Split each line once, clean the needed fields once, then compute the typed output and
    the reject reason inside one generator over a one-element array.

    Catalyst pushes filters below projections by inlining the projected expressions, so a
    ``reject_reason IS NULL`` filter on plain projections would re-split the line once per
    referenced field.  It does not push a filter on generator output below the generator,
    so here each line is parsed exactly once, whatever filter follows (``good``/``rejects``).
    ``fields`` maps names to expressions over the field array; ``build`` maps the cleaned
    field columns and the field count to the output columns.
    """
    carry = [c for c in lines.columns if keep_line or c != line_col]
    cut = split_quoted(F.col(line_col), sep) if quoted else F.split(F.col(line_col), sep, -1)
    split = lines.select(*carry, cut.alias("_parts"))
    parts = F.col("_parts")
    cleaned = split.select(*carry, F.coalesce(F.size(parts), F.lit(0)).alias("_n"),
                           *[expr(parts).alias(f"_f_{name}") for name, expr in fields.items()])
    out = build({name: F.col(f"_f_{name}") for name in fields}, F.col("_n"))
    row = F.struct(*[col.alias(name) for name, col in out.items()])
    return cleaned.select(*carry, F.inline(F.array(row)))


def _cleaned(pos: int):
    return lambda parts: clean_text(_field(parts, pos))


def _raw(pos: int):
    return lambda parts: _field(parts, pos)


def parse_activity_lines(lines: DataFrame, line_col: str = "line", keep_line: bool = False,
                         quoted: bool = False) -> DataFrame:
    """``quoted=True`` keeps commas inside double quotes in their field (the export's own
    positional split, the default, cuts there too)."""
    def build(f: dict[str, Column], n_fields: Column) -> dict[str, Column]:
        longs = {name: to_long(f[name]) for name in ("account_key", "heading_id", "directory_id", "referer_id")}
        mobile_number = to_long(f["is_mobile"])
        reason = (F.when(n_fields < ACTIVITY_MIN_FIELDS, F.lit(SHORT_ROW))
                  .when(reduce(operator.or_, [c.isNull() for c in [*longs.values(), mobile_number]]),
                        F.lit(BAD_NUMBER)))
        return {
            "account_key": longs["account_key"],
            "keywords": f["keywords"],
            "date_text": f["date"],
            "heading_id": longs["heading_id"],
            "directory_id": longs["directory_id"],
            "referer_id": longs["referer_id"],
            "impression_weight": tolerant_double(f["impression_weight"]),
            "click_weight": tolerant_double(f["click_weight"]),
            "is_mobile": mobile_number == F.lit(1),   # a flag is true only as the integer 1
            "reject_reason": reason,
        }
    fields = {name: _cleaned(pos) for name, pos in ACTIVITY_POSITIONS.items()}
    return _parse(lines, line_col, ",", keep_line, fields, build, quoted)


def parse_account_lines(lines: DataFrame, line_col: str = "line", keep_line: bool = False) -> DataFrame:
    def build(f: dict[str, Column], n_fields: Column) -> dict[str, Column]:
        key = to_long(f["account_key"])
        vertical = F.replace(F.upper(java_trim(f["vertical"])), F.lit('"'), F.lit(""))
        reason = (F.when(n_fields < ACCOUNT_MIN_FIELDS, F.lit(SHORT_ROW))
                  .when(key.isNull(), F.lit(BAD_NUMBER))
                  .when(~vertical.isin(*KEPT_VERTICALS), F.lit(OTHER_VERTICAL)))
        return {"account_key": key, "account_id": f["account_id"], "account_name": f["account_name"],
                "vertical": vertical, "reject_reason": reason}
    fields = {"account_key": _cleaned(ACCOUNT_POSITIONS["account_key"]),
              "account_id": _raw(ACCOUNT_POSITIONS["account_id"]),
              "account_name": _raw(ACCOUNT_POSITIONS["account_name"]),
              "vertical": _raw(ACCOUNT_POSITIONS["vertical"])}
    return _parse(lines, line_col, ";", keep_line, fields, build)


def parse_extract_lines(lines: DataFrame, line_col: str = "line", keep_line: bool = False) -> DataFrame:
    def build(f: dict[str, Column], n_fields: Column) -> dict[str, Column]:
        key, directory = to_long(f["account_key"]), to_long(f["directory_id"])
        reason = (F.when(n_fields < EXTRACT_MIN_FIELDS, F.lit(SHORT_ROW))
                  .when(key.isNull() | directory.isNull(), F.lit(BAD_NUMBER)))
        return {"account_key": key, "directory_id": directory, "impressions": f["impressions"],
                "clicks": f["clicks"], "reject_reason": reason}
    fields = {name: _cleaned(pos) for name, pos in EXTRACT_POSITIONS.items()}
    return _parse(lines, line_col, ";", keep_line, fields, build)


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(parsed: DataFrame, *id_cols: str) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*id_cols, F.col("reject_reason").alias("reason"))
