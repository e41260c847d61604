"""URL filter: host and path rules first, else a logistic regression on hashed character n-grams.

Rules are a short list that the caller gives, MAX_RULES at most (more is an error), tested longest first in one projection
without a shuffle. The model is trained on a small labelled table, TRAIN_URLS rows at most: those whose urls hash lowest.
Everything is DataFrame operations and Spark's own library.

Defined results: host and path of a null url, or one without ://, are empty; no rule fits an empty host; without labelled
urls of both kinds, urls that no rule fits are allowed; rows with null or repeated ids stay rows of their own; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES, TRAIN_URLS, REGULARISATION = 1_000, 5_000, 0.0003
GRAMS, FEATURES = (3, 4, 5), 131_072
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

#: Fixed values of the labelled table: usual words of unwanted sites by kind, and of harmless ones by subject.
UNWANTED = {
    "adult": "adult porn sex xxx nude erotic escort camgirls fetish milf hentai playmates",
    "adverts": "ads adserver adclick banner popunder track tracker tracking affiliate clicks pixel doubleclick",
    "gambling": "casino poker slots roulette betting bets jackpot lotto bingo blackjack wager bookmaker",
    "pharmacy": "pills pharmacy viagra cialis meds drugstore steroids painkillers tramadol xanax supplements dietpills",
    "spam": "spam linkfarm seolinks backlinks freemoney prize winner giveaway payday loans replica getrich",
    "malware": "keygen warez crack serials phishing verify-account login-update malware torrentz hacked toolbar-download antivirus-alert",
}
HARMLESS = {
    "places": "city village harbor museum library gallery theatre garden park station market bridge",
    "learning": "school university college science history physics chemistry language grammar lecture campus research",
    "news": "news daily weekly journal press report herald tribune gazette radio weather archive",
    "living": "recipes cooking kitchen travel hotel family health dental clinic music dance photo",
    "work": "software engineering law office bank insurance build repair energy transport farm craft",
    "people": "anna martin peter schmidt garcia dubois rossi kowalski novak jensen silva tanaka",
}
CONSONANTS, VOWELS = "bcdfghjklmnprstvwz", "aeiou"


def labelled_words() -> list[tuple[str, int]]:
    """The words of both kinds, and as many invented harmless names, which most hosts have: by rule, consonant and vowel in turn, or closed syllables."""
    words = [(w, label) for label, kinds in ((1, UNWANTED), (0, HARMLESS)) for group in kinds.values() for w in group.split()]
    names = []
    for k in range(300):
        x, name = 7919 * k + 31, ""
        for _ in range(2 + k % 3):
            x = (x * 1103515245 + 12345) % 2**31
            name += CONSONANTS[(x >> 8) % len(CONSONANTS)] + VOWELS[(x >> 16) % len(VOWELS)] + (CONSONANTS[(x >> 20) % len(CONSONANTS)] if k % 2 else "")
        names.append((name, 0))
    return words + names


SHAPES = ("https://{w}.com/", "http://www.{w}.org/index.html", "http://m.{w}.info/page?id={n}", "https://best-{w}.com/about/", "http://{w}-online.org/{n}.html", "https://my{w}.net/a/b/{n}", "https://{w}24.net/en/{n}", "http://blog.{w}shop.example/fr/{n}/")


def labelled_urls(spark: SparkSession, words: list[tuple[str, int]] | None = None) -> DataFrame:
    """A small labelled table: url, label (1: block). Each word stands in hosts of several shapes, so that shapes say nothing."""
    rows = [(shape.format(w=w, n=100), label) for w, label in words or labelled_words() for shape in SHAPES]
    return spark.createDataFrame(rows, "url string, label int")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule, h: Column, p: Column) -> Column:
    return ((h == rule.host) | h.endswith("." + rule.host)) & p.startswith(rule.path)


def rule_columns(rules: tuple[Rule, ...], h: Column, p: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; {MAX_RULES} at most")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = _fits(rule, h, p)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _grams(text: Column) -> Column:
    own = F.concat(F.lit("^"), F.translate(text, "123456789", "000000000"), F.lit("$"))  # which number it is says nothing

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(own) - n + 1)
        return F.when(F.char_length(own) >= n, F.transform(starts, lambda i: F.substring(own, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, GRAMS))


def _features(df: DataFrame) -> DataFrame:
    """grams of host and path, told apart, hashed to FEATURES numbers."""
    tagged = F.concat(F.transform(_grams(F.col("host")), lambda g: F.concat(F.lit("h:"), g)), F.transform(_grams(F.col("path")), lambda g: F.concat(F.lit("p:"), g)))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(df.withColumn("grams", tagged)).drop("grams")


def train(labelled: DataFrame):
    """A fitted model, or None without urls of both kinds."""
    rows = labelled.where("url is not null and label in (0, 1)").orderBy(F.xxhash64("url"), "url", "label").limit(TRAIN_URLS).select(F.col("label").cast("double").alias("label"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    shares = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(shares) < 2:
        return None
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(shares[0.0] / shares[1.0])).otherwise(1.0))  # both kinds weigh the same
    return LogisticRegression(maxIter=60, regParam=REGULARISATION, standardization=False, featuresCol="features", labelCol="label", weightCol="weight").fit(_features(rows).coalesce(1))  # TRAIN_URLS rows at most


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of the model; null where there is none)."""
    base = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    model = train(labelled)
    if model is None:
        scored = base.withColumn("score", F.lit(None).cast("double"))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(_features(base)).withColumn("score", vector_to_array("probability")[1])
    name, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    return scored.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(F.coalesce("score", F.lit(0.0)) >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
