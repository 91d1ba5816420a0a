"""Text cleaning and the search-term / merchant-name match, as native Column expressions.

Everything here compiles into whole-stage codegen; there is no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim() strips every character <= U+0020 (controls and blank) at both ends;
# Spark's one-argument trim only strips blanks, so the set is spelled out.
JAVA_TRIM_CHARS = "".join(chr(code) for code in range(0x21))

# Characters dropped before comparing a term with a name, and the domain
# suffixes cut from the end of a term (case-sensitive, once).
TERM_DROP_CHARS = "- '"
DOMAIN_SUFFIXES = (".ca", ".com")
# The placeholder term counted separately.
NONE_TERM = "NONE"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip characters <= U+0020 at both ends.  The set trim is only applied when the first
    or last character is in the set (a one-character comparison); most values pass as is."""
    c = _col(c)
    blank = F.lit(" ")
    at_edge = (F.left(c, F.lit(1)) <= blank) | (F.right(c, F.lit(1)) <= blank)
    return F.when(at_edge, F.btrim(c, F.lit(JAVA_TRIM_CHARS))).otherwise(c)


def clean_text(c: Column | str) -> Column:
    """Drop every double quote, then trim as Java does."""
    return java_trim(F.replace(_col(c), F.lit('"'), F.lit("")))


def strip_domain_suffix(c: Column | str) -> Column:
    """Cut a trailing ``.ca`` or ``.com`` once (``dominos.com.ca`` -> ``dominos.com``)."""
    c = _col(c)
    out = c
    for suffix in reversed(DOMAIN_SUFFIXES):
        out = F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(out)
    return out


def squeeze(c: Column | str) -> Column:
    """Remove ``-``, blank and ``'``, then upper-case."""
    return F.upper(F.translate(_col(c), TERM_DROP_CHARS, ""))


def normalised_term(term: Column | str) -> Column:
    return squeeze(strip_domain_suffix(term))


def normalised_name(name: Column | str) -> Column:
    return squeeze(name)


def _half_prefix(t: Column) -> Column:
    return F.left(t, F.floor(F.length(t) / 2).cast("int"))


def branch_contains(t: Column, n: Column) -> Column:
    return n.contains(t)


def branch_half_prefix(t: Column, n: Column) -> Column:
    return (F.length(t) >= 10) & n.contains(_half_prefix(t))


def branch_edit_distance(t: Column, n: Column) -> Column:
    # levenshtein with a threshold stops early and returns -1 once the limit is passed,
    # so the test is ">= 0", never "<= k".
    limit = F.floor(F.length(t) / 3).cast("int")
    return F.call_function("levenshtein", t, n, limit) >= 0


def normalised_match(t: Column | str, n: Column | str, strict: bool = False) -> Column:
    """The match on already normalised term ``t`` and name ``n``.

    The name contains the term, or a term of 10+ characters has its first half in the
    name, or the edit distance is at most a third of the term length.  The cheap branches
    come first: Spark short-circuits OR, so levenshtein only runs when both containment
    tests fail.  An empty term matches every name unless ``strict``.  NULL -> False.
    """
    t, n = _col(t), _col(n)
    matched = branch_contains(t, n) | branch_half_prefix(t, n) | branch_edit_distance(t, n)
    if strict:
        matched = (F.length(t) > 0) & matched
    return F.coalesce(matched, F.lit(False))


def name_match(term: Column | str, name: Column | str, strict: bool = False) -> Column:
    """True when a (cleaned) search term designates the (cleaned) merchant name: a domain
    suffix is cut from the term, both are squeezed, then ``normalised_match``."""
    return normalised_match(normalised_term(term), normalised_name(name), strict)


def is_empty_term(term: Column | str) -> Column:
    return java_trim(term) == F.lit("")


def is_none_term(term: Column | str) -> Column:
    return F.upper(java_trim(term)) == F.lit(NONE_TERM)


# Characters the SQL study removes from the keyword and from the name.
STUDY_KEYWORD_DROP = "- "
STUDY_NAME_DROP = "' "


def study_keyword(keyword: Column | str) -> Column:
    return F.upper(F.translate(_col(keyword), STUDY_KEYWORD_DROP, ""))


def study_name(name: Column | str) -> Column:
    return F.upper(F.translate(_col(name), STUDY_NAME_DROP, ""))


def non_name_search(keyword: Column | str, name: Column | str) -> Column:
    """The SQL study's predicate: keyword without ``-``/blank differs from the name without
    ``'``/blank, both upper-cased.  The removed sets differ on purpose.  NULL -> not counted."""
    return non_name_of(study_keyword(keyword), study_name(name))


def non_name_of(kw: Column | str, name_key: Column | str) -> Column:
    """The same predicate on already squeezed keyword and name."""
    return F.coalesce(_col(kw) != _col(name_key), F.lit(False))
