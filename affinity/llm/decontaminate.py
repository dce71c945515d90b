"""Benchmark decontamination with a distributed positional inverted index.

Only DataFrame functions. The words of the documents that occur in some test
window are stored as postings (term, document, position) in a table; it is
the only pass over the texts. A window is then looked up from its rarest
term: the list of that term, moved by the term's offset in the window, gives
the candidate starts; the lists of the other terms, rarest next, are moved by
their own offsets and intersected with them.

A posting list may be hot, so it is never gathered: lists are intersected by
equi-joins on (document, position), which no single term can skew. The test
windows are joined by broadcast only while their measured number stays under
``BROADCAST_ROWS``.

``exact_matches`` returns every occurrence of a window, ``proximity_matches``
every place where all of an item's rare terms lie within a span, and
``contamination`` the summary per document.

Defined results: null and empty texts have no words; an item without words, or
with a null id, has no window; equal windows of different items are matched
once and reported for each; every input row has a result row, and rows that
share an id but not the text are told apart by a hash of the text; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import ascii_lower, shared_table

# Words are runs of A-Z, a-z, 0-9 and everything beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """The words of a text in order, not yet lower-cased; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")


def test_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms) for each window of ``size`` consecutive words; an item of
    fewer words, but not none, is one window."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"),
                         F.transform(words_of(F.col(text_col)), ascii_lower).alias("w")).filter("item_id IS NOT NULL AND size(w) > 0")
    return words.select("item_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))).alias("at"), "w") \
        .select("item_id", F.slice("w", F.col("at"), F.lit(size)).alias("terms")).distinct()


def _small(df: DataFrame) -> DataFrame:
    """A broadcast hint if the measured number of rows is within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (term, doc_id, tag, pos) of ``terms`` (word, term); positions
    count from 1. Each row of ``docs`` also has one posting of term -1 with its
    number of words as pos. ``tag`` is a hash of the text."""
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tag"),
                        words_of(F.col(text_col)).alias("w"))
    # the empty string, which is no word, stands before each text and is term -1
    placed = words.select("doc_id", "tag", F.size("w").alias("n"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("at", "raw"))
    marked = terms.select("word", "term").union(terms.sparkSession.createDataFrame([("", -1)], "word string, term long"))
    return placed.withColumn("word", ascii_lower(F.col("raw"))).join(_small(marked), "word").select(
        "term", "doc_id", "tag", F.when(F.col("term") == -1, F.col("n")).otherwise(F.col("at")).alias("pos"))


class TestIndex:
    """The windows of a test set, and the postings of their terms in a corpus."""

    def __init__(self, docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text"):
        found = shared_table(test_windows(items, size, item_col, item_text))
        distinct = shared_table(found.select("terms").distinct().withColumn("win", F.monotonically_increasing_id()))
        self.items = found.join(distinct, "terms").select("item_id", "win")
        spread = distinct.select("win", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "word"))
        terms = shared_table(spread.select("word").distinct().withColumn("term", F.monotonically_increasing_id()))
        self.postings = shared_table(build_index(docs, terms, id_col, text_col))
        self.counts = shared_table(self.postings.filter("term >= 0").groupBy("term").agg(F.count("*").alias("df")))
        # rank 1 is the rarest term; a window with a term of no posting occurs nowhere
        ranked = spread.join(terms, "word").join(self.counts, "term").withColumn(
            "rank", F.row_number().over(Window.partitionBy("win").orderBy("df", "off")))
        whole = ranked.groupBy("win").agg(F.count("*").alias("n"))
        self.terms = shared_table(ranked.join(whole, "win").filter("n = len").select("win", "len", "off", "term", "rank", "df"))

    def _lists(self, low: int, high: int) -> DataFrame:
        """Postings of the terms that have a rank from ``low`` to ``high`` in some window."""
        wanted = self.terms.filter(F.col("rank").between(low, high)).select("term").distinct()
        return self.postings.join(_small(wanted), "term", "left_semi")

    def exact_matches(self) -> DataFrame:
        """(win, doc_id, tag, start, len): each place where a window occurs."""
        first = self.terms.filter("rank = 1").select("win", "len", "off", "term")
        starts = self._lists(1, 1).join(_small(first), "term").select(
            "win", "len", "doc_id", "tag", (F.col("pos") - F.col("off")).alias("start")).filter("start >= 1")
        starts = shared_table(self._intersect(starts, 2, 2))
        return shared_table(self._intersect(starts, 3, 1 << 30, only_docs=True))

    def _intersect(self, starts: DataFrame, low: int, high: int, only_docs: bool = False) -> DataFrame:
        """The candidate starts at which the terms of ranks ``low`` to ``high`` also stand."""
        others = self.terms.filter(F.col("rank").between(low, high)).select("win", "off", "term")
        need = others.groupBy("win").agg(F.count("*").alias("need"))
        wanted = starts.join(_small(others), "win").withColumn("pos", F.col("start") + F.col("off"))
        lists = self._lists(low, high).select("term", "doc_id", "tag", "pos")
        if only_docs:
            where = starts.select(F.col("doc_id").alias("d"), F.col("tag").alias("t")).distinct()
            lists = lists.join(_small(where), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t")), "left_semi")
        right = lists.select(F.col("term").alias("t_"), F.col("doc_id").alias("d_"), F.col("tag").alias("g_"), F.col("pos").alias("p_")).distinct()
        met = wanted.join(right, (F.col("tag") == F.col("g_")) & (F.col("pos") == F.col("p_"))
                          & (F.col("term") == F.col("t_")) & F.col("doc_id").eqNullSafe(F.col("d_")))
        full = met.groupBy("win", "len", "doc_id", "tag", "start").agg(F.count_distinct("off").alias("met"))
        kept = full.join(_small(need), "win").filter("met = need").select("win", "len", "doc_id", "tag", "start")
        alone = starts.join(_small(need.select("win")), "win", "left_anti").select("win", "len", "doc_id", "tag", "start").distinct()
        return kept.union(alone)

    def proximity_matches(self, rare: int = 3, span: int = 50) -> DataFrame:
        """(item_id, doc_id, tag, pos): postings of an item's rarest term that have
        its ``rare`` rarest distinct terms (or all, if fewer) within ``span``
        positions. Positions are met by blocks of ``span``, not by document."""
        own = self.items.join(self.terms, "win").groupBy("item_id", "term").agg(F.first("df").alias("df"))
        own = own.withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy("df", "term"))).filter(F.col("r") <= rare)
        own = shared_table(own.withColumn("need", F.count("*").over(Window.partitionBy("item_id"))))
        posts = self.postings.join(_small(own.select("term").distinct()), "term", "left_semi")
        lead = posts.join(_small(own.filter("r = 1").select("item_id", "term", "need")), "term").drop("term")
        lead = lead.withColumn("block", F.explode(F.array(*[F.floor(F.col("pos") / span) + d for d in (-1, 0, 1)])))
        near = posts.join(_small(own.select("item_id", "term")), "term").select(
            F.col("item_id").alias("i_"), "term", F.col("doc_id").alias("d_"), F.col("tag").alias("g_"), F.col("pos").alias("p_"),
            F.floor(F.col("pos") / span).alias("b_"))
        met = lead.join(near, (F.col("item_id") == F.col("i_")) & (F.col("tag") == F.col("g_")) & (F.col("block") == F.col("b_"))
                        & F.col("doc_id").eqNullSafe(F.col("d_"))).filter(F.abs(F.col("pos") - F.col("p_")) <= span)
        return met.groupBy("item_id", "doc_id", "tag", "pos", "need").agg(F.count_distinct("term").alias("n")) \
            .filter("n = need").select("item_id", "doc_id", "tag", "pos")

    def contamination(self) -> DataFrame:
        """Per row of the corpus: doc_id, tag, n_words, n_hit (words inside any
        occurrence), items (sorted ids of the items found)."""
        met = self.exact_matches()
        hit = met.select("doc_id", "tag", "start", "len").distinct().select(
            "doc_id", "tag", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos")) \
            .distinct().groupBy("doc_id", "tag").agg(F.count("*").alias("n_hit"))
        items = met.join(_small(self.items), "win").groupBy("doc_id", "tag").agg(
            F.array_sort(F.collect_set("item_id")).alias("items"))
        both = hit.join(items, hit["doc_id"].eqNullSafe(items["doc_id"]) & (hit["tag"] == items["tag"])).select(
            hit["doc_id"].alias("d_"), hit["tag"].alias("g_"), "n_hit", "items")
        heads = self.postings.filter("term = -1").select("doc_id", "tag", F.col("pos").cast("long").alias("n_words"))
        return heads.join(both, heads["doc_id"].eqNullSafe(F.col("d_")) & (F.col("tag") == F.col("g_")), "left").select(
            "doc_id", "tag", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of ``items``."""
    found = TestIndex(docs, items, size, id_col, text_col, item_col, item_text).exact_matches()
    bad = found.select(F.col("doc_id").alias("__d"), F.col("tag").alias("__g")).distinct()
    tagged = docs.withColumn("__tag", F.xxhash64(F.col(text_col)))
    return tagged.join(_small(bad), F.col(id_col).eqNullSafe(F.col("__d")) & (F.col("__tag") == F.col("__g")), "left_anti").drop("__tag")
