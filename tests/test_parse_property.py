"""The activity-line parser against a plain statement of its rules over generated lines."""

import random
import re

from leadscope.sources import exports
from tests.conftest import as_parquet

INT = re.compile(r"[+-]?[0-9]+")


def _clean(s: str) -> str:
    s = s.replace('"', "")
    lo, hi = 0, len(s)
    while lo < hi and s[lo] <= " ":
        lo += 1
    while hi > lo and s[hi - 1] <= " ":
        hi -= 1
    return s[lo:hi]


def _long(s: str):
    s = _clean(s)
    if INT.fullmatch(s) and -(2 ** 63) <= int(s) < 2 ** 63:
        return int(s)
    return None


def expected(line: str):
    f = line.split(",")
    if len(f) < 18:
        return ("short_row",)
    longs = [_long(f[i]) for i in (2, 4, 5, 7, 15)]
    if any(v is None for v in longs):
        return ("bad_number",)
    key, heading, directory, referer, mobile = longs
    return (None, key, _clean(f[17]), _clean(f[3]), heading, directory, referer, mobile == 1)


TOKENS = ["1", "42", "-7", "+3", "0", "x", "", " ", "1.5", "n/a", "99999999999999999999", '"5"', ' "6" ', "\t8",
          "a b", "pizza", '"pizza hut"', "2013-05-10"]


def _line(rng: random.Random) -> str:
    n = rng.choice([3, 17, 18, 18, 18, 19, 25])
    return ",".join(rng.choice(TOKENS) for _ in range(n))


def test_activity_parser_agrees_with_the_rules(spark, scratch):
    rng = random.Random(7)
    lines = [(i, _line(rng)) for i in range(3000)]
    df = exports.parse_activity_lines(as_parquet(spark, lines, "id int, line string", scratch))
    got = {r.id: r for r in df.collect()}
    bad = []
    for i, line in lines:
        want, r = expected(line), got[i]
        if want[0] is not None:
            if r.reject_reason != want[0]:
                bad.append((line, r.reject_reason, want))
        else:
            have = (r.reject_reason, r.account_key, r.keywords, r.date_text, r.heading_id, r.directory_id,
                    r.referer_id, r.is_mobile)
            if have != want:
                bad.append((line, have, want))
    assert not bad, bad[:5]
    reasons = {r.reject_reason for r in got.values()}
    assert reasons == {None, "short_row", "bad_number"}   # every outcome is exercised
