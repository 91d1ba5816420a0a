"""Date checks: per-component ranges and well-formed calendar date texts."""

from __future__ import annotations

import datetime as _dt
import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted range of each date component, by the two letters that start the component's
# name.  The year is never wrong.  Hours run 1-24 and minutes and seconds 1-60 (0 refused, 60 accepted).
COMPONENT_RANGES = {"MM": (1, 12), "DD": (1, 31), "hh": (1, 24), "mm": (1, 60), "ss": (1, 60)}
YEAR_CODE = "YY"
MISSING_VALUE = "no value"
DATE_TEXT_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def component_violation(value: Column | str, component: Column | str) -> Column:
    """Message for a date component outside its range; NULL when the value is acceptable.

    ``component`` is a Column, or a plain string taken as the literal component name; its
    trimmed first two characters pick the rule.  An unknown code always gives a message.
    """
    value = _col(value)
    comp = F.lit(component) if isinstance(component, str) else component
    code = F.left(F.trim(comp), F.lit(2))
    ranges = F.create_map(*[F.lit(x) for c, (low, high) in COMPONENT_RANGES.items() for x in (c, f"{low}-{high}")])
    inside = reduce(operator.or_, [(code == c) & value.between(low, high) for c, (low, high) in COMPONENT_RANGES.items()])
    allowed = F.try_element_at(ranges, code)
    return (F.when(code == YEAR_CODE, F.lit(None).cast("string"))
            .when(allowed.isNull(), F.concat(F.lit("no rule for component "), F.coalesce(comp, F.lit("NULL"))))
            .when(value.isNull(), F.lit(MISSING_VALUE))
            .when(~inside, F.concat(code, F.lit("="), value.cast("string"), F.lit(", allowed "), allowed)))


def is_date_text(c: Column | str) -> Column:
    """Whole text is ``yyyy-MM-dd`` and names a real calendar day (2014-02-31 is not)."""
    c = _col(c)
    return F.coalesce(c.rlike(DATE_TEXT_PATTERN) & F.try_to_date(c, "yyyy-MM-dd").isNotNull(),
                      F.lit(False))


def parse_date_text(c: Column | str) -> Column:
    c = _col(c)
    return F.when(is_date_text(c), F.try_to_date(c, "yyyy-MM-dd"))


_DATE_ARG = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")


def date_argument(value: str | _dt.date) -> _dt.date:
    """Validate a job argument given as ``yyyy-MM-dd`` text (or a date)."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if not isinstance(value, str) or not _DATE_ARG.fullmatch(value):
        raise ValueError(f"not a yyyy-MM-dd date: {value!r}")
    return _dt.date.fromisoformat(value)
