"""Benchmark decontamination over a distributed positional inverted index (DataFrame functions only).

The index holds a posting (term, document, position) for every occurrence of every term that the test
items use, in files sorted by term, and one closing entry per document with its word count.  A test
phrase is looked up from its rarest term: the posting lists of its rarest terms, each moved back by the
term's offset in the phrase, are intersected on (document, start); what is left looks up its remaining
terms at their positions.  A slack above zero gives proximity matches: every term within that many
positions of its place in the phrase.

Words are runs of ``WORD`` after lower-casing A-Z.  A window is ``width`` consecutive item words; an item
with fewer (but some) words is one window.

Defined cases: NULL and empty texts have no words; equal windows of several items count for each of them;
items without words name nothing; a NULL item_id hits words and is not counted as an item; rows with the
same doc_id and text get the same result, one row each; rows with the same doc_id and different texts
are kept apart; a NULL doc_id keeps its row, and no id is taken for none.  Extra columns are not read,
whatever their names; ``clean`` carries all columns along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadscope.llm.common import ascii_lower, written
from leadscope.plans.sizing import bounded_broadcast

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NULL_ID = (1 << 63) - 1
#: Documents are filtered by this many hash slots before the last lookup: the broadcast stays within it.
SLOTS = 1 << 18
DOC = ["doc", "version"]


def words_of(text):
    """Array of the words of a text column."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAK), "")


def identity(id_col, text_col):
    """(doc, version) of a document: its id, and a hash of its text that tells texts under one id apart.  The
    lowest bit of the hash says that there is no id, so no id is taken for none."""
    doc = id_col.cast("long")
    return (F.coalesce(doc, F.lit(NULL_ID)),
            F.xxhash64(text_col).bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(doc.isNull().cast("long")))


def id_of(doc, version):
    """The id behind the two, or NULL."""
    return F.when(version.bitwiseAND(F.lit(1).cast("long")) == 0, doc)


def phrase_windows(items: DataFrame, width: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, phrase, terms): the windows of the items; ``phrase`` identifies a window's words."""
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return (words.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), width).alias("terms"))
            .select("item_id", F.concat_ws(" ", "terms").alias("phrase"), "terms").distinct())


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: (term, doc, version, pos).  ``terms`` has one row per distinct ``term``.

    ``version`` tells texts under one id apart.  The empty term closes a document: pos is its word count.
    """
    wanted = bounded_broadcast(terms.union(terms.sparkSession.range(1).select(F.lit("").alias("term"))))
    doc, version = identity(F.col(id_col), F.col(text_col))
    words = docs.select(doc.alias("doc"), version.alias("version"), words_of(F.col(text_col)).alias("w"))
    postings = words.select(*DOC, F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "term"))
    return written(postings.join(wanted, "term").select("term", *DOC, "pos").sortWithinPartitions("term", *DOC), "postings")


def phrase_matches(index: DataFrame, phrases: DataFrame, slack: int = 0, lead: int = 2) -> DataFrame:
    """(doc, version, phrase, start, size) for every occurrence of the phrases.

    ``phrases`` has distinct ``phrase`` rows with their ``terms``.  The ``lead`` rarest terms of each
    phrase are intersected first.  With ``slack`` > 0 a start counts when each term lies within ``slack``
    positions of its place, seen from the rarest term.
    """
    frequency = written(index.where("term <> ''").groupBy("term").agg(F.count("*").alias("df")), "frequency")
    parts = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("off", "term"))
    rare = Window.partitionBy("phrase").orderBy("df", "off")
    ranked = (parts.join(bounded_broadcast(frequency), "term")
              .withColumn("rank", F.row_number().over(rare))
              .withColumn("known", F.count("*").over(Window.partitionBy("phrase"))))
    ranked = written(ranked.where("known = size").select("phrase", "size", "off", "term", "rank"), "phrases")
    moves = [F.lit(d) for d in range(-slack, slack + 1)]

    first = bounded_broadcast(ranked.where("rank = 1"))
    found = (index.join(first, "term")
             .select(*DOC, "phrase", "size", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0"))
    for rank in range(2, lead + 1):
        terms = bounded_broadcast(ranked.where(F.col("rank") == rank).select("term", "phrase", "off"))
        places = index.join(terms, "term").select(*DOC, "phrase", "pos", "off")
        if slack:
            places = places.select(*DOC, "phrase", "pos", "off", F.explode(F.array(*moves)).alias("move"))
        else:
            places = places.withColumn("move", F.lit(0))
        places = places.select(*DOC, "phrase", (F.col("pos") - F.col("off") + F.col("move")).alias("start")).distinct()
        long_enough = found.where(F.col("size") >= rank).join(places, [*DOC, "phrase", "start"], "left_semi")
        found = long_enough.unionByName(found.where(F.col("size") < rank))
    found = written(found.distinct(), "candidates")

    rest = bounded_broadcast(ranked.where(F.col("rank") > lead).select("phrase", "off", "term"))
    slot = lambda: F.pmod(F.xxhash64(*DOC), F.lit(SLOTS))
    slots = F.broadcast(found.select(slot().alias("slot")).distinct())
    near = (index.where("term <> ''").withColumn("slot", slot()).join(slots, "slot", "left_semi")
            .select(*DOC, "pos", "term"))
    asked = found.join(rest, "phrase").withColumn("place", F.col("start") + F.col("off"))
    asked = asked.withColumn("move", F.explode(F.array(*moves))) if slack else asked.withColumn("move", F.lit(0))
    asked = asked.select(*DOC, "phrase", "start", "size", "off", "term", (F.col("place") + F.col("move")).alias("pos"))
    held = (asked.join(near, [*DOC, "pos", "term"], "left_semi")
            .groupBy(*DOC, "phrase", "start", "size").agg(F.countDistinct("off").alias("held")))
    whole = held.where(F.col("held") == F.col("size") - lead).drop("held")
    return whole.unionByName(found.where(F.col("size") <= lead))


def summarize(index: DataFrame, matches: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated.  ``items``: (item_id, phrase)."""
    text = F.struct(*DOC)
    ordered = Window.partitionBy(*DOC).orderBy("start", "size").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select(*DOC, "start", "size").distinct()
    hit = (spans.withColumn("reached", F.coalesce(F.max(F.col("start") + F.col("size")).over(ordered), F.lit(0)))
           .groupBy(*DOC).agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("size")
                                               - F.greatest("start", "reached"))).cast("long").alias("n_hit")))
    named = (matches.select(*DOC, "phrase").distinct()
             .join(bounded_broadcast(items.where("item_id is not null")), "phrase")
             .groupBy(*DOC).agg(F.collect_set(F.col("item_id").cast("string")).alias("ids")))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return (index.where("term = ''").select(*DOC, F.col("pos").cast("long").alias("n_words"))
            .join(hit, DOC, "left").join(named, DOC, "left")
            .select(*DOC, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(ids).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.sort_array(ids)), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def find_matches(docs: DataFrame, items: DataFrame, width: int = 10, slack: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, matches, item windows) of the items in the documents."""
    windows = written(phrase_windows(items, width), "windows")
    index = build_index(docs, windows.select(F.explode("terms").alias("term")).distinct(), id_col, text_col)
    phrases = windows.select("phrase", "terms").distinct()
    return index, phrase_matches(index, phrases, slack), windows.select("item_id", "phrase").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document with its exact matches."""
    index, matches, named = find_matches(docs, items, width, 0, id_col, text_col)
    out = summarize(index, written(matches, "matches"), named)
    return out.select(id_of(F.col("doc"), F.col("version")).alias("doc_id"), "n_words", "n_hit", "n_items",
                      "items_sha256", "contaminated")


def contaminated(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Distinct (doc, version) of the documents with an exact match; see ``build_index`` for the two."""
    _, matches, _ = find_matches(docs, items, width, 0, id_col, text_col)
    return matches.select(*DOC).distinct()


def clean(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the documents that hold a window of the items."""
    hit = contaminated(docs, items, width)
    doc, version = identity(docs["doc_id"], docs["text"])
    return docs.join(hit, (doc == hit["doc"]) & (version == hit["version"]), "left_anti")
