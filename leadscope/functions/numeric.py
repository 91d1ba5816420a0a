"""Tolerant numeric conversions used by the ingest and the totals job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An amount is summed exactly, whatever its size and in whatever order: it becomes entries of whole numbers
# in slots, each slot is summed as a BIGINT, and the total is put together and rounded once.
#
#   slot 0        amounts below 2**24 with at most six decimals, both of a row at once: whole part and
#                 millionths of each, so ordinary rows cost four BIGINT sums
#   other slots   the exact DOUBLE of any other amount, 24 bits to a slot, from 2**-1152 to 2**1032
#
# An entry is at most 2**24, so a slot holds the sum of 2**38 rows; Spark raises an error beyond.
ORDINARY_BELOW, MILLION, LIMB = 2.0 ** 24, 10 ** 6, 1 << 24
LOWEST, HIGHEST = -48, 42                                # 24-bit places of a DOUBLE
_DIGITS = 4                                              # 53 bits, and where the first may lie in its place
_MEASURE_SLOTS = 1000                                    # place p of measure m (1 or 2) is slot 1000 m + 100 + p
WHOLE_TYPE = "decimal(38,0)"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c: Column | str) -> Column:
    """Text -> BIGINT, NULL when the text is not an integer."""
    return _col(c).try_cast("bigint")


def tolerant_double(c: Column | str) -> Column:
    """Text -> DOUBLE; text that does not parse counts as 0.0."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def finite_number(c: Column | str) -> Column:
    """Text -> DOUBLE; text that is no finite number counts as 0.0."""
    number = _col(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number), F.lit(0.0))


def _is_ordinary(number: Column) -> Column:
    """Below the bound, and given back by its rounded millionths: the decimal text has at most six decimals."""
    return (F.abs(number) < ORDINARY_BELOW) & (F.rint(number * 1e6) / 1e6 == number)


def _whole(number: Column) -> Column:
    """The whole part of a number that is not negative, as DOUBLE (``floor`` gives a BIGINT)."""
    return F.when(number < 2.0 ** 53, F.floor(F.least(number, F.lit(2.0 ** 53))).cast("double")).otherwise(number)


def _parts(number: Column) -> tuple[Column, Column]:
    """Whole part and millionths of an ordinary number, zeros for others; both are exact as doubles."""
    millionths = F.when(_is_ordinary(number), F.rint(number * 1e6)).otherwise(F.lit(0.0))
    whole = F.floor(millionths / MILLION)
    return whole, (millionths - whole * MILLION).cast("bigint")


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _digit(number: Column, top: Column, k: Column) -> Column:
    """24 bits of a number: digit ``k`` below place ``top``.  Scaling by powers of two and taking whole parts are
    exact; a logarithm that is a little off only moves a bit to the next digit."""
    half = F.pow(F.lit(2.0), top * F.lit(-12))
    scaled = F.abs(number) * half * half * F.pow(F.lit(2.0), k * 24)
    digit = _whole(scaled) - F.when(k > 0, _whole(scaled / LIMB) * LIMB).otherwise(F.lit(0.0))
    return F.when(number < 0, -digit).otherwise(digit).cast("bigint")


def with_entries(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``rows`` with slot, a, b, c, d in place of its two columns of finite numbers: one or more rows for each,
    whose sums by slot make up the totals.  A row with two ordinary numbers stays one row; for the others
    each group of bits is a row."""
    x, y = F.col(first), F.col(second)
    pieces = F.array(*[F.lit(k) for k in range(1 + 2 * _DIGITS)])
    kept = [c for c in rows.columns if c not in (first, second)]
    taken = rows.select(*kept, x.alias("_x"), y.alias("_y"),
                        F.explode(F.when(_is_ordinary(x) & _is_ordinary(y), F.array(F.lit(0))).otherwise(pieces)).alias("_piece"))
    piece, of_first = F.col("_piece"), F.col("_piece") <= _DIGITS
    placed = taken.select(*kept, "_x", "_y", "_piece", F.when(of_first, F.col("_x")).otherwise(F.col("_y")).alias("_n"),
                          F.when(of_first, F.lit(_MEASURE_SLOTS)).otherwise(F.lit(2 * _MEASURE_SLOTS)).alias("_slot"),
                          F.pmod(piece - 1, F.lit(_DIGITS)).alias("_k"))
    number, k = F.col("_n"), F.col("_k")
    plain = (piece == 0) | _is_ordinary(number)                # an ordinary number is in piece 0
    top = F.floor(F.log2(F.abs(number)) / 24)
    values = [F.when(piece == 0, v).otherwise(_long(0)) for n in ("_x", "_y") for v in _parts(F.col(n))]
    values[0] = F.when(piece == 0, _parts(F.col("_x"))[0]).when(plain, _long(0)).otherwise(_digit(number, top, k))
    slot = F.when(plain, F.lit(0)).otherwise(F.col("_slot") + F.lit(100) + top - k)
    return placed.select(*kept, slot.cast("int").alias("slot"), *[v.cast("bigint").alias(n) for n, v in zip("abcd", values)])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once.  What the lambda holds stays out of the generated code, so
    rare cases do not make the code of ordinary rows too long to be compiled."""
    return F.get(F.transform(F.array(value), body), 0)


def _slot_sum(wide: Column, slot: Column) -> Column:
    """The sum in one slot of an array of (slot, a)."""
    return F.aggregate(wide, _long(0), lambda total, e: total + F.when(e["slot"] == slot, e["a"]).otherwise(_long(0)))


def _with_slots(wide: Column, slot: int, whole: Column, micro: Column) -> Column:
    """floor(``whole`` + ``micro`` millionths + the places + 0.5) as BIGINT, at its bounds when it lies beyond them.

    Carrying upwards leaves digits of 24 bits and a signed rest above them; the digits below one give their
    millionths on the way.  The five lowest digits from one on and ``whole`` are far below 2**124; so from
    16 * 2**120 on, what lies above decides alone."""
    big = lambda x: F.lit(str(x)).cast(WHOLE_TYPE)
    powers = F.array(*[big(LIMB ** k) for k in range(5)])

    def step(state: Column, q: Column) -> Column:
        value = _slot_sum(wide, q + F.lit(slot + 100)) + state["carry"]
        return _let(value, lambda v: _let(F.pmod(v, _long(LIMB)), lambda digit: F.struct(
            F.shiftright(v, 24).alias("carry"),                       # rounds down, below zero as well
            F.when(q < 0, F.shiftright(digit * _long(MILLION) + state["micro"], 24)).otherwise(state["micro"]).alias("micro"),
            F.when((q >= 0) & (q < 5), (state["low"] + digit.cast(WHOLE_TYPE) * F.get(powers, q)).cast(WHOLE_TYPE))
            .otherwise(state["low"]).alias("low"),
            F.when(q == 5, digit).otherwise(state["fifth"]).alias("fifth"),
            (state["zero"] & ((q < 6) | (digit == 0))).alias("zero"),
            (state["full"] & ((q < 6) | (digit == LIMB - 1))).alias("full"))))

    start = F.struct(_long(0).alias("carry"), _long(0).alias("micro"), big(0).alias("low"), _long(0).alias("fifth"),
                     F.lit(True).alias("zero"), F.lit(True).alias("full"))

    def end(state: Column) -> Column:
        above = (F.when(state["zero"] & (state["carry"] == 0), state["fifth"])
                 .when(state["full"] & (state["carry"] == -1), state["fifth"] - LIMB)
                 .when(state["carry"] < 0, _long(-LIMB)).otherwise(_long(LIMB)))
        near = (state["low"] + _rounded(whole, micro + state["micro"]).cast(WHOLE_TYPE)).cast(WHOLE_TYPE)
        return _let(above, lambda high: F.when(high > 15, _long(HIGH)).when(high < -16, _long(LOW)).otherwise(
            _bounded((high.cast(WHOLE_TYPE) * big(1 << 120) + near).cast(WHOLE_TYPE))))

    lowest = F.least(F.lit(0), F.array_min(F.transform(wide, lambda e: e["slot"])) - F.lit(slot + 100))
    return F.aggregate(F.sequence(lowest, F.lit(HIGHEST)), start, step, end)


def _rounded(whole: Column, micro: Column) -> Column:
    """floor(whole + micro millionths + 0.5) of BIGINTs."""
    half = micro + _long(MILLION // 2)
    return whole + ((half - F.pmod(half, _long(MILLION))) / MILLION).cast("bigint")


def _bounded(whole: Column) -> Column:
    """A whole number as BIGINT, at its bounds beyond them."""
    return F.least(F.greatest(whole, F.lit(LOW).cast(WHOLE_TYPE)), F.lit(HIGH).cast(WHOLE_TYPE)).cast("bigint")


def exact_total(measure: int, whole: Column, micro: Column, wide: Column) -> Column:
    """floor(total + 0.5) as BIGINT, at its bounds beyond them, of the first (1) or second (2) amount:
    ``whole`` and ``micro`` are its sums in slot 0, ``wide`` the (slot, a) sums of the other slots."""
    slot = _MEASURE_SLOTS * measure

    def general(group: Column) -> Column:
        own = F.filter(group["wide"], lambda e: (e["slot"] >= slot) & (e["slot"] < slot + _MEASURE_SLOTS))
        return _let(own, lambda mine: F.when(F.size(mine) == 0, _rounded(group["whole"], group["micro"]))
                    .otherwise(_with_slots(mine, slot, group["whole"], group["micro"])))

    return F.when(F.size(wide) == 0, _rounded(whole, micro)).otherwise(
        _let(F.struct(whole.alias("whole"), micro.alias("micro"), wide.alias("wide")), general))
