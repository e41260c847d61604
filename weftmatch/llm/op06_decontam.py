"""Benchmark decontamination with a positional inverted index.

1. Windows of consecutive words are cut from the items.
2. The postings (document, word, position) of all words of the windows are stored, in one pass over the texts without a
   shuffle; the words are counted from them.
3. The lists of a window, each less the word's place in the window, are intersected from the rarest word on: first those of
   its two rarest words, then, at the few starts that both have, the lists of all others. What every list has is an
   occurrence; the texts are not looked at again.
4. Overlapping windows are united to the words that are hit; items are gathered for each document.

All of it is DataFrame operations. Lists are never gathered in a row: a hot word's postings stay where they were read and are
joined to the windows it is a rarest word of, a table that is bounded by the benchmark, and broadcast only when it is counted to
be small.

Defined results: a null or empty text has no words, no hits; an item without words has no windows; an item of fewer words
than a window is one window; equal windows of several items count for each; documents with an equal id and text give equal
rows; the list of no items is the empty text; other columns are ignored. With null_ids, as in the query and the pipeline,
items with a null id are searched like all others: together they count as one item in n_items, and items_sha256 leaves them
out, as in the SQL. Without it they are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, unlike

WIDTH = 10
#: Rows up to which a table made from the benchmark, or of document keys, is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key: the id and a hash of the text; rows that agree in both have the same results."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("key", F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.xxhash64("text")))


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text", null_ids: bool = False) -> DataFrame:
    """item_id, window array<string>."""
    cut = (items if null_ids else items.where(F.col(id_col).isNotNull())).select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(width)))
    return cut.select("item_id", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("at")).select("item_id", F.slice("w", F.col("at"), F.col("n")).alias("window"))


def build_index(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """key, term, pos: the postings of the given terms in all documents; rows that agree in key repeat theirs."""
    return keyed.select("key", F.posexplode(words(F.col("text"))).alias("pos", "term")).join(_small(terms), "term").select("key", "term", "pos")


def exact_matches(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """key, wid, start, n: every occurrence of every window (wid, window) in the documents (key, text)."""
    slots = windows.select("wid", F.size("window").alias("n"), F.posexplode("window").alias("off", "term"))
    index = stored(build_index(keyed, stored(slots.select("term").distinct(), "terms")), "postings")
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    rank = Window.partitionBy("wid").orderBy("freq", "off")  # a window's words
    ranked = slots.join(counts, "term", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    ranked = ranked.withColumn("rank", F.row_number().over(rank)).withColumn("rarest", F.min("freq").over(Window.partitionBy("wid")))
    ranked = stored(ranked.where("rarest > 0").select("wid", "n", "term", "off", "rank"), "ranked")

    lists = index.join(_small(ranked.where("rank <= 2")), "term").select("key", "wid", "n", "rank", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    first, second = lists.where("rank = 1").drop("rank"), lists.where("rank = 2").select("key", "wid", "start")
    starts = stored(first.where("n = 1").unionByName(first.where("n > 1").join(second, ["key", "wid", "start"], "left_semi").select(first.columns)).distinct(), "starts")

    rest = ranked.where("rank > 2").select("wid", "term", "off")
    wanted = stored(starts.join(_small(rest), "wid").select("key", "wid", "start", "n", "term", (F.col("start") + F.col("off")).alias("pos")), "wanted")
    # the places grow with the documents and are shuffled at every size, after postings of other documents have gone
    near = index.join(_small(wanted.select("key").distinct()), "key", "left_semi")
    proved = near.join(wanted.hint("merge"), ["key", "term", "pos"]).groupBy("key", "wid", "start", "n").agg(F.count_distinct("pos").alias("met")).where("met = n - 2")
    return starts.where("n <= 2").unionByName(proved.drop("met"))


def proximity_matches(index: DataFrame, queries: DataFrame, slop: int) -> DataFrame:
    """qid, key, pos: places of the rarest term of a query (qid, terms) that have all its other terms at most slop words away."""
    terms = queries.select("qid", F.explode(F.array_distinct("terms")).alias("term"))
    sizes = terms.groupBy("qid").agg(F.count(F.lit(1)).alias("n_terms"))
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    rarest = terms.join(counts, "term").groupBy("qid").agg(F.min_by("term", F.struct("freq", "term")).alias("term"))
    at = index.join(terms, "term").select("qid", "key", "term", "pos", F.floor(F.col("pos") / (slop + 1)).alias("cell"))
    anchors = at.join(rarest, ["qid", "term"], "left_semi").select("qid", "key", F.col("pos").alias("here"), F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    near = anchors.join(at, ["qid", "key", "cell"]).where(F.abs(F.col("pos") - F.col("here")) <= slop)
    return near.groupBy("qid", "key", "here").agg(F.count_distinct("term").alias("met")).join(sizes, "qid").where("met = n_terms").select("qid", "key", F.col("here").alias("pos"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, null_ids: bool = False) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated."""
    keyed = _keyed(docs, id_col, text_col)
    cut = stored(item_windows(items, width, null_ids=null_ids), "cut")
    windows = stored(cut.select("window").distinct().select(F.monotonically_increasing_id().alias("wid"), "window"), "windows")
    matches = stored(exact_matches(keyed, windows), "matches")

    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)  # the matches of a document
    spans = matches.select("key", "start", (F.col("start") + F.col("n")).alias("stop"), "n").distinct().withColumn("past", F.coalesce(F.max("stop").over(before), F.lit(0)))
    hits = spans.groupBy("key").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "past"))).cast("long").alias("n_hit"))
    owners = cut.join(windows, "window").select("wid", "item_id").distinct()
    named = matches.select("key", "wid").distinct().join(_small(stored(owners, "owners")), "wid").select("key", F.col("item_id").cast("string").alias("item_id")).distinct()
    lists = named.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("ids"))
    results = stored(hits.join(lists, "key"), "results")

    all_docs = keyed.select("id", "key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return all_docs.join(results, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")).cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, null_ids: bool = False) -> DataFrame:
    """The documents without a word that is hit, with all their columns."""
    keyed = _keyed(docs, id_col, text_col)
    windows = stored(item_windows(items, width, null_ids=null_ids).select("window").distinct().select(F.monotonically_increasing_id().alias("wid"), "window"), "windows")
    dirty = stored(exact_matches(keyed, windows).select("key").distinct(), "dirty")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    name = unlike(docs.columns, "dirty_key")
    return docs.join(_small(dirty.select(F.col("key").alias(name))), key == F.col(name), "left_anti")
