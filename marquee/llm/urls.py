"""URL filter (operator 10), in DataFrame functions only.

Rules of host and path decide first, the longest that fits. Other URLs are judged by a logistic regression
on hashed character 3-grams of host and path, trained from a small labelled table of URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules, as (verdict, host, path).
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# URLs labelled by hand, 1 for one to block.
BLOCKED = """
https://spam-farm.example.org/en/1 http://www.spam-farm.example.com/es/22?page=2 https://m.spam-links.example.org/en/7.html
http://cheap-pills.example.com/en/3 https://www.cheap-pills.example.org/fr/41/ http://blog.cheap-meds.example.com/en/9?utm_source=feed
https://casino-win.example.com/en/5#top http://m.casino-win.example.org/es/77 https://www.casino-bonus.example.com/en/8.html
https://free-bets.example.com/en/2 http://blog.free-bets.example.org/es/15?page=2&ref=x https://free-spins.example.com/en/6/
http://ads-track.example.com/fr/12 https://www.ads-track.example.org/en/30.html https://m.ads-click.example.com/en/4#top
https://win-money.example.com/en/11 http://pills-shop.example.org/en/18 https://adult-cams.example.com/en/27
""".split()
ALLOWED = """
https://therin.example.com/en/676 http://www.ththen.example.org/es/148.html https://blog.tionsh.example.com/en/960
http://tionble.example.org/es/9086 https://m.ththed.example.org/en/7890#top https://therat.example.com/en/3658?utm_source=feed
http://news.example.com/en/100 https://www.library.example.org/en/20/ https://blog.garden.example.com/es/31?page=2&ref=x
https://weather.example.org/en/44 http://m.history.example.com/fr/58.html https://www.science.example.com/en/61#top
http://travel.example.org/es/73 https://recipes.example.com/en/85/ https://blog.museum.example.org/en/92?utm_source=feed
http://schools.example.com/en/13 https://www.theatre.example.org/en/29 https://m.ththing.example.com/en/37?page=2
https://ththnd.example.com/en/1357 http://www.theres.example.org/en/9142/ https://docs.example.com/fr/64
""".split()

BUCKETS = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u, 1.0) for u in BLOCKED] + [(u, 0.0) for u in ALLOWED], "url string, label double")


def host_of(url: Column) -> Column:
    rest = F.regexp_replace(_after_scheme(url), r"(?s)[/?#].*", "")
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.regexp_replace(_after_scheme(url), r"(?s)^[^/?#]*", "")
    return F.regexp_replace(rest, r"(?s)[?#].*", "")


def _after_scheme(url: Column) -> Column:
    """Behind the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def buckets(host: Column, path: Column, n: int) -> Column:
    """Buckets of the 3-grams of host and path, each with its ends marked."""

    def of(part: Column, name: str) -> Column:
        marked = F.concat(F.lit("^"), part, F.lit("$"))
        places = F.when(F.length(marked) >= 3, F.sequence(F.lit(1), F.length(marked) - 2)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.pmod(F.xxhash64(F.concat(F.lit(name), F.substring(marked, i, F.lit(3)))), F.lit(n)).cast("int"))

    return F.concat(of(host, "h"), of(path, "p"))


def train_url_model(labelled: DataFrame, *, n: int = BUCKETS) -> tuple[list[float], float]:
    """Weights and intercept from a small table of url and label; rows without a label are left out.

    A feature is the share of a URL's 3-grams in a bucket. With one label only, every URL gets that label;
    without any row all are allowed.
    """
    rows = labelled.where("label is not null")
    ends = rows.agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    if ends.low is None or ends.low == ends.high:
        return [0.0] * n, 1.0 if ends.low else -1.0
    found = buckets(host_of(F.col("url")), path_of(F.col("url")), n)
    dense = F.expr(f"transform(sequence(0, {n - 1}), b -> size(filter(found, f -> f = b)) / greatest(1, size(found)))")
    model = LogisticRegression(regParam=1e-4, maxIter=200, standardization=False).fit(
        rows.select("label", found.alias("found")).select(array_to_vector(dense).alias("features"), "label")
    )
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def judge_urls(pages: DataFrame, model: tuple[list[float], float], *, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Verdict on every URL, one row per row of pages: id_col, host, path, rule, verdict, p_block.

    A rule fits its host and all subdomains if the path starts with the rule's. A URL that is null or has no
    ``://`` has an empty host and path, fits no rule and is judged on those. Null and repeated ids are kept;
    other columns are left out, whatever their names.
    """
    weights, intercept = model
    listed = F.split(F.lit(" ".join(map(repr, weights))), " ").cast("array<double>")
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, say).otherwise(verdict)
    found = buckets(F.col("host"), F.col("path"), len(weights))
    total = F.aggregate(F.col("found"), F.lit(0.0), lambda s, b: s + F.element_at(listed, b + 1))
    margin = F.lit(intercept) + total / F.greatest(F.lit(1), F.size("found"))
    judged = urls.select("id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"), found.alias("found"))
    judged = judged.withColumn("p_block", 1 / (1 + F.exp(-margin)))
    own = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), "p_block")
