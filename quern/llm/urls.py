"""URL filter: host and path rules, and a logistic regression on hashed character n-grams.

The regression is Spark ML's, fitted on a small labelled table of URLs.
"""

from __future__ import annotations

import random
from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FEATURES = 1 << 15
GRAMS = (3, 4, 5)
THRESHOLD = 0.7

#: The rules of the production query: verdict, host, path (fixed values).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words of hosts and paths that the labelled table marks as unwanted, and words of ordinary ones.
UNWANTED = "casino win bets bet poker slots jackpot pills cheap viagra pharma adult xxx porn sex cams escort spam farm ads track adserver popunder clicks banner warez torrent crack keygen loans payday replica dating hookup lottery free-money seo-links malware phish".split()
WANTED = "news daily times journal library museum school university college science history garden recipe cooking travel weather health hospital city council sport football music theatre books review forum wiki docs guide manual research archive gallery market bank energy transport village river forest bakery studio design software".split()

#: Frequent English letter pairs, of which ordinary names are made up (fixed values).
PAIRS = "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le sa si ar ve ra ld ur".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): 1 to block. Both classes share subdomains, endings and kinds of path."""
    starts, ends = ("", "www.", "m.", "blog."), ("example.com", "example.org", "example.net")
    paths = ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}?page=2", "/{}", "/a/b/{}#top", "")
    plain = ("ther", "tion", "ing", "ent", "ance", "over", "ment", "ston", "ber", "al")
    rows = []
    for k, word in enumerate(UNWANTED):
        mate = UNWANTED[(k * 7 + 3) % len(UNWANTED)]
        names = (f"{word}-{mate}", f"{word}-{plain[k % 10]}", f"{plain[k % 10]}-{word}", f"{word}{k % 9}", word, f"{mate}{word}", f"{mate}-{word}", f"{word}-x", f"{word}{plain[k % 7]}", f"the-{word}")
        rows += [(f"https://{starts[(k + j) % 4]}{n}.{ends[(k + j) % 3]}{paths[(k + j) % 7].format(k * 37 % 9999)}", 1.0) for j, n in enumerate(names)]
        rows.append((f"http://{plain[k % 10]}{plain[(k + 3) % 10]}.{ends[k % 3]}/{word}/{mate}-{k}.html", 1.0))
    for k, (word, more) in enumerate(product(WANTED, plain[:6])):
        name = (word, f"{word}-{more}", f"{more}{plain[k % 10]}", f"{more}{word}", f"{plain[k % 10]}{more}", f"{more}-{plain[k % 7]}")[k % 6]
        rows.append((f"https://{starts[k % 4]}{name}.{ends[k % 3]}{paths[k % 7].format(k * 53 % 9999)}", 0.0))
        if k % 3 == 0:
            rows.append((f"http://{more}{plain[k % 10]}.{ends[k % 3]}/{word}/{more}-{k}.html", 0.0))
    rng = random.Random(11)
    for k in range(500):  # ordinary made-up names of frequent letter pairs
        name = "".join(rng.choices(PAIRS, k=rng.randint(2, 5))) + rng.choice(("", "", "ing", "ly", "ble", "s"))
        name += rng.choice(("", "", "", "-" + "".join(rng.choices(PAIRS, k=2))))
        rows.append((f"https://{starts[k % 4]}{name}.{ends[k % 3]}{paths[k % 7].format(rng.randint(1, 9999))}", 0.0))
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty for null or where ``://`` is missing."""
    whole = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(whole, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(whole, pattern, 2)


def grams(host: Column, path: Column, sizes: tuple[int, ...] = GRAMS) -> Column:
    """Character n-grams of the bounded host and path, marked by where they come from; a number
    counts as one digit."""

    def of(text: Column, mark: str, n: int) -> Column:
        count = F.length(text) - (n - 1)
        places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(mark), F.substring(text, i, n)))

    bounded = [F.regexp_replace(F.concat(F.lit("^"), part, F.lit("$")), "[0-9]+", "0") for part in (host, path)]
    return F.concat(*[of(text, mark, n) for text, mark in zip(bounded, "hp") for n in sizes])


def _hashed(urls: DataFrame) -> DataFrame:
    host, path = split_url(F.col("url"))
    parts = urls.withColumn("host", host).withColumn("path", path)
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(parts.withColumn("grams", grams(F.col("host"), F.col("path"))))


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """Fit on (url, label) rows; the table is small by contract and goes through one partition."""
    return LogisticRegression(maxIter=60, regParam=0.002, tol=1e-4, standardization=False).fit(_hashed(labelled).select("features", "label"))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule; null where none fits. Rules of equal
    length are tried in text order."""
    found = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        hit = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, model: LogisticRegressionModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(key, host, path, rule, verdict, block_score) for every row; only the url is read.

    A null or relative url has an empty host and path and is judged by the model like others.
    Repeated rows stay. ``block_score`` is the model's probability of block, with or without a rule.
    """
    model = model or train(labelled_urls(pages.sparkSession))
    slim = _hashed(pages.select(F.col(key).alias("key"), F.col(url).alias("url"))).select("key", "host", "path", "features")
    scored = model.transform(slim).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    score = F.element_at(vector_to_array("probability"), 2)
    return scored.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
        score.alias("block_score"),
    )
