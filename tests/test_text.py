"""Golden vectors for cleaning, the name match and its branches."""

from pyspark.sql import functions as F

from leadscope.functions import text as tx
from tests.conftest import as_parquet

MATCH_VECTORS = [
    # The first five pairs must give these results. (term, name, expected)
    ("Dominos", "Dominos P", True),          # contains
    ("Dominos", "Dominos Pizza", True),      # contains
    ("Dominos", "Dmino", True),              # edit distance 2 <= 7 div 3
    ("Dominos Pizza", "Dominos P", True),    # first half of a 12-char term
    ("Dominos Pizza", "Dmino Pzz", True),    # edit distance 4 <= 4
    ("NONE", "Anything", False),
    ("pizza.com", "Pizza", True),            # suffix cut
    ("pizza.COM", "Pizza", False),           # suffix cut is case-sensitive
    ("dominos.com.ca", "Dominos.com", True),  # cut once: dominos.com
    ("", "Anything", True),                  # empty term matches everything
    ("-", "Anything", True),
    ("'", "Anything", True),
    (".com", "Anything", True),
    ("Tim Horton's", "tim-hortons", True),
    ("kitten", "sitting", False),            # distance 3 > 6 div 3
    (None, "Anything", False),
    ("Dominos", None, False),
]


def test_name_match_vectors(spark, scratch):
    df = as_parquet(spark, MATCH_VECTORS, "term string, name string, expected boolean", scratch)
    out = df.select("term", "name", "expected", tx.name_match("term", "name").alias("got")).collect()
    bad = [(r.term, r.name, r.expected, r.got) for r in out if r.expected != r.got]
    assert not bad, bad


def test_strict_requires_a_term(spark, scratch):
    df = as_parquet(spark, [("", "X"), ("-", "X"), ("x", "X")], "term string, name string", scratch)
    got = {r.term: r.m for r in df.select("term", tx.name_match("term", "name", strict=True).alias("m")).collect()}
    assert got == {"": False, "-": False, "x": True}


def test_branches_separately(spark, scratch):
    rows = [("customer-000000012", "Customer 000000012"),   # all three
            ("customer 00000 shop", "Customer 000000012"),  # not contained; half prefix; distance 4 <= 5
            ("customer 00000 shop", "Customer 000123456"),  # half prefix only (distance 8 > 5)
            ("custmer 000000012", "Customer 000000012")]    # edit distance only
    df = as_parquet(spark, rows, "term string, name string", scratch)
    t, n = tx.normalised_term(F.col("term")), tx.normalised_name(F.col("name"))
    got = {(r.term, r.name): (r.a, r.b, r.c) for r in df.select(
        "term", "name", tx.branch_contains(t, n).alias("a"), tx.branch_half_prefix(t, n).alias("b"),
        tx.branch_edit_distance(t, n).alias("c")).collect()}
    assert got == {rows[0]: (True, True, True), rows[1]: (False, True, True),
                   rows[2]: (False, True, False), rows[3]: (False, False, True)}


def test_clean_text(spark, scratch):
    rows = [("Maple Leaf Diner, open late", "Maple Leaf Diner, open late"),     # already clean
            ('Maple "Leaf" Diner, open late', "Maple Leaf Diner, open late"),   # inner quotes dropped
            ('\t "CUSTOMER 1" \x01\n', "CUSTOMER 1"),
            ("\x00x\x00", "x"),
            ("a ", "a "),  # no-break space is above U+0020: Java trim keeps it
            (None, None)]
    df = as_parquet(spark, rows, "raw string, clean string", scratch)
    got = [(r.clean, r.got) for r in df.select("clean", tx.clean_text("raw").alias("got")).collect()]
    assert all(a == b for a, b in got), got


def test_empty_and_none(spark, scratch):
    rows = [("",), (" ",), (" none ",), ("None",), ("NONE!",), (None,)]
    df = as_parquet(spark, rows, "term string", scratch)
    got = [(r.e, r.n) for r in df.select(tx.is_empty_term("term").alias("e"), tx.is_none_term("term").alias("n")).collect()]
    assert got == [(True, False), (True, False), (False, True), (False, True), (False, False), (None, None)]


def test_non_name_predicate_asymmetry(spark, scratch):
    rows = [("tim-hortons", "Tim Horton's", False),  # '-' dropped from the keyword, "'" from the name
            ("timhortons", "Tim Horton's", False),
            ("Tim Horton's", "Tim Hortons", True),    # "'" is kept on the keyword side
            ("Tim Hortons", "Tim-Hortons", True),     # '-' is kept on the name side
            (None, "x", False)]
    df = as_parquet(spark, rows, "kw string, name string, expected boolean", scratch)
    got = [(r.expected, r.got) for r in df.select("expected", tx.non_name_search("kw", "name").alias("got")).collect()]
    assert all(a == b for a, b in got), got


def test_levenshtein_vectors(spark, scratch):
    df = as_parquet(spark, [("bakery", "bakery", 0), ("kitten", "sitting", 3), ("flaw", "lawn", 2)],
                    "a string, b string, d int", scratch)
    got = [(r.d, r.got) for r in df.select("d", F.levenshtein("a", "b").alias("got")).collect()]
    assert all(a == b for a, b in got), got
