"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory above.

Units of text are compared: a whole file, its head (HEAD_LINES lines), each paragraph (lines between lines without words) and each line. Weights
are (1 + ln tf) * idf. Document frequencies of the templates' words are counted over all files; words that no template has
count as found in no file. A unit has a licence when its cosine to a template is THRESHOLD or more and it has the words
that the template must have. Such a unit holds a key word: the lightest words of a template, as long as their squared
weights stay below THRESHOLD**2, cannot reach it alone; the other words are key words. Units without any are left out
beforehand, exactly, and so are units with so many words of their own that they cannot reach it. A file's own licence is that of its best unit; a licence of last resort counts only where no other is
found.

A file without a licence of its own inherits from the nearest directory, its own or one above, that has a licence
file (named licence, license, copying or notice) with a licence; of several in one directory the best score counts, on a
tie the first id.

Defined results: a null text has no units; a null path is the root directory and no name; rows with equal id and path are
one file, each text of which is scored by itself; without a licence anywhere, license is null; a tie goes to the larger unit, then
the earlier one, then the first name; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .licence_texts import LAST_RESORT, TEMPLATES, Template

THRESHOLD, HEAD_LINES = 0.6, 30
UNITS = ("whole", "head", "paragraph", "line")
#: Rows up to which a table of files, directories or terms is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000
LICENCE_FILE = r"^(?i)(licen[cs]e|copying|notice)([._-].*)?$"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def split_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def unit_weights(templates: Iterable[Template], df: dict[str, int], n: int) -> list[dict[str, float]]:
    """Of each template: unit weights of its words."""
    out = []
    for template in templates:
        words = split_words(template.text)
        w = {t: (1 + math.log(words.count(t))) * idf(df.get(t, 0), n) for t in sorted(set(words))}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.append({t: x / norm for t, x in w.items()})
    return out


def idf(df: int, n: int) -> float:
    return math.log((1 + n) / (1 + df)) + 1


def key_words(weights: list[dict[str, float]], threshold: float) -> list[str]:
    """Words of which a unit has at least one if it reaches the threshold with any template."""
    keys = set()
    for w in weights:
        light = 0.0
        for t, x in sorted(w.items(), key=lambda p: (p[1], p[0])):
            light += x * x
            if light >= threshold**2 - 1e-9:
                keys.add(t)
    return sorted(keys)


def any_of(words: list[str]) -> str:
    """A pattern for one of the words, none of which begins another: it branches letter by letter, so that a text is not tried with each of them."""

    def branch(rest: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for w in filter(None, rest):
            heads.setdefault(w[0], []).append(w[1:])
        ways = [re.escape(c) + branch(tails) for c, tails in sorted(heads.items())]
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})" if ways else ""

    return branch(sorted(set(words)))


def key_pattern(words: list[str]) -> str:
    """One of the words as a whole word; ones that are the beginning of another are tried by themselves."""
    begins = [w for w in words if any(x != w and x.startswith(w) for x in words)]
    others = [w for w in words if w not in begins]
    ways = [any_of(others), *map(re.escape, begins)]
    return r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(w for w in ways if w) + r")(?![\p{L}\p{N}])"


def _units(files: DataFrame) -> DataFrame:
    """file_id, path, row (a hash of the text), kind (a place in UNITS), no, said."""
    lines = F.split("text", "\n")
    one = lambda kind, text: F.array(F.struct(F.lit(kind).alias("kind"), F.lit(0).alias("no"), text.alias("said")))
    many = lambda kind, texts: F.transform(texts, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("no"), x.alias("said")))
    paragraphs = F.split("text", r"\n(?:[^\p{L}\p{N}\n]*\n)+")
    none = F.array().cast("array<struct<kind:int,no:int,said:string>>")
    # a unit that is all of a larger one scores as that one does, which comes first
    parts = [F.when(F.size(lines) > HEAD_LINES, one(1, F.array_join(F.slice(lines, 1, HEAD_LINES), "\n"))), F.when(F.size(paragraphs) > 1, many(2, paragraphs)), F.when(F.size(lines) > 1, many(3, lines))]
    every = F.concat(one(0, F.col("text")), *(x.otherwise(none) for x in parts))
    return files.select("file_id", "path", F.xxhash64("text").alias("row"), F.explode(every).alias("u")).select("file_id", "path", "row", "u.*")


def _can_reach(said: Column, idfs: dict[str, float], rare: float, threshold: float) -> Column:
    """Whether enough of a unit's weight is on the templates' words: its cosine is at most the share of its norm that they have.

    Each other word weighs `rare` at least, so the number of distinct other words bounds the rest of the norm from below.
    """
    words = _words(said)
    known = F.array_intersect(words, F.array(*map(F.lit, idfs)))
    weight = F.create_map(*(F.lit(x) for pair in idfs.items() for x in pair))
    square = lambda t: F.pow((1 + F.log(F.size(F.filter(words, lambda w: w == t)).cast("double"))) * F.element_at(weight, t), F.lit(2.0))
    inside = F.aggregate(known, F.lit(0.0), lambda acc, t: acc + square(t))
    others = (F.size(F.array_distinct(words)) - F.size(known)) * rare**2
    return inside * (1 - threshold**2) >= threshold**2 * others - 1e-6


def licence_units(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """file_id, path, row, kind, no, license, score: the units with a licence, of files (file_id, path, text)."""
    spark = files.sparkSession
    terms = sorted({t for x in templates for t in split_words(x.text)})
    vocabulary = spark.createDataFrame([(t,) for t in terms], "term string")
    n = files.count()
    found = files.select(F.explode(F.array_distinct(_words(F.coalesce("text", F.lit(""))))).alias("term")).join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = {r["term"]: r["df"] for r in found.collect()}  # the templates' words at most
    weights = unit_weights(templates, df, n)
    pattern = key_pattern(key_words(weights, threshold))

    unit = ["file_id", "path", "row", "kind", "no"]
    idf_of = {t: idf(df.get(t, 0), n) for t in terms}
    some = _units(files.where(F.col("text").rlike(pattern))).where(F.col("said").rlike(pattern)).where(_can_reach(F.col("said"), idf_of, idf(0, n), threshold)).distinct()
    tf = some.select(*unit, F.explode(_words(F.col("said"))).alias("term")).groupBy(*unit, "term").agg(F.count(F.lit(1)).alias("tf"))
    idfs = spark.createDataFrame(list(idf_of.items()), "term string, idf double")
    weighed = stored(tf.join(F.broadcast(idfs), "term", "left").withColumn("w", (1 + F.log("tf")) * F.coalesce("idf", F.lit(idf(0, n)))).select(*unit, "term", "w"), "weighed")
    norms = weighed.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    rows = [(k, x.license, len(x.must), t, u, int(t in x.must)) for k, (x, w) in enumerate(zip(templates, weights, strict=True)) for t, u in w.items()]
    known = spark.createDataFrame(rows, "template int, license string, need int, term string, u double, must int")
    dots = weighed.join(F.broadcast(known), "term").groupBy(*unit, "template", "license", "need").agg(F.sum(F.col("w") * F.col("u")).alias("dot"), F.sum("must").alias("met")).where("met = need")  # the templates' words
    same = [dots[c].eqNullSafe(norms[c]) for c in unit]
    return dots.join(norms, same).select(*(dots[c] for c in unit), "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).where(F.col("score") >= threshold)


def scan(files: DataFrame, templates: tuple[Template, ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """file_id, path, own_license, own_score, own_unit, license, inherited_from (a directory; null for an own or no licence)."""
    files = files.select("file_id", F.coalesce("path", F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    units = licence_units(files, templates, threshold)
    first = F.struct(F.col("license").isin(*LAST_RESORT).alias("last"), (-F.col("score")).alias("s"), "kind", "no", "license")  # the least comes first
    own = units.groupBy("file_id", "path").agg(F.min(first).alias("b"))
    kinds = F.array(*map(F.lit, UNITS))
    own = stored(own.select("file_id", "path", F.col("b.license").alias("own_license"), (-F.col("b.s")).alias("own_score"), F.get(kinds, F.col("b.kind")).alias("own_unit")), "own")
    directory = F.regexp_extract("path", r"^(?s)(.*)/[^/]*$", 1)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    sources = own.where(name.rlike(LICENCE_FILE)).groupBy(directory.alias("source")).agg(F.min_by("own_license", F.struct((-F.col("own_score")).alias("s"), "file_id", "path")).alias("source_license"))
    sources = stored(sources, "sources")

    folders = files.select(directory.alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))))
    chain = folders.select("dir", F.posexplode(above).alias("depth", "source"))
    nearest = chain.join(_small(sources), "source").groupBy("dir").agg(F.max_by("source_license", "depth").alias("dir_license"), F.max_by("source", "depth").alias("dir_source"))
    nearest = stored(nearest, "nearest")

    at = files.select("file_id", "path", directory.alias("dir"))
    mine = own.select(F.col("file_id").alias("own_id"), F.col("path").alias("own_path"), "own_license", "own_score", "own_unit")
    with_own = at.join(_small(mine), F.col("file_id").eqNullSafe(F.col("own_id")) & (F.col("path") == F.col("own_path")), "left")
    return with_own.join(_small(nearest), "dir", "left").select(
        "file_id", "path", "own_license", "own_score", "own_unit", F.coalesce("own_license", "dir_license").alias("license"),
        F.when(F.col("own_license").isNull() & F.col("dir_license").isNotNull(), F.col("dir_source")).alias("inherited_from"),
    )


def files_of(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source/b<n>/d<n>/name; every tenth id is a licence file. Ids that are no whole numbers count by their hash."""
    said = F.coalesce(F.col("doc_id").cast("string"), F.lit("0"))
    i = F.coalesce(said.try_cast("long"), F.pmod(F.xxhash64(said), F.lit(1_000_000)))
    name = F.when(i % 10 == 0, F.concat(F.lit("LICENSE-"), said)).otherwise(F.concat(F.lit("f"), said, F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.concat(F.lit("b"), F.floor(i / 1000).cast("string")), F.concat(F.lit("d"), (F.floor(i / 50) % 20).cast("string")), name)
    return docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
