"""URL filters: host and path rules first, then a logistic regression over hashed character n-grams of host and path.

The regression is fitted by Spark's own learner to the small labelled table below; scoring is one projection of built-in
functions, with the weights as a constant array.

Defined results: a null url, or one without "://", has an empty host and path, fits no rule and has no n-grams but its
edges, so the bias and their weights decide. Repeated rows are judged alike; an empty table gives no rows. The columns are
added under the names host, path, rule, verdict and score; inputs with such names are taken in a struct first.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules as host and path; the longest that fits decides.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

#: Labelled urls: 1 for pages to block.
LABELLED = [
    *((u, 1) for u in """
http://spam-farm.example.org/en/1 https://www.spam-farm.example.com/fr/22 http://m.spam-farm.example.org/buy https://best-spam.example.com/en/3
http://cheap-pills.example.com/en/450 https://www.cheap-pills.example.org/de/7 http://blog.cheap-pills.example.com/x https://cheap-meds.example.org/order
http://casino-bonus.example.com/win https://free-casino.example.org/en/77 http://win-prize.example.com/claim https://lottery-win.example.org/es/3
http://hot-dates.example.com/join https://adult-cams.example.org/live http://xxx-tube.example.com/en/9 https://free-money.example.com/now
http://replica-watches.example.org/sale https://seo-links.example.com/buy-links http://click-bait.example.org/top10 https://malware-download.example.com/exe
http://phish-login.example.org/verify https://crack-keygen.example.com/free http://viagra-cheap.example.org/pills https://loan-fast.example.com/apply
http://m.casino-win.example.com/play/3.html https://free-bets.example.org/en/5 http://blog.poker-bets.example.com/win https://www.casino-win.example.org/de/1.html
""".split()),
    *((u, 0) for u in """
https://www.example.com/en/25 http://blog.example.org/en/960 https://m.example.com/fr/825 http://docs.example.org/guide/start.html
https://library.example.org/catalog/12 http://news.example.com/es/533 https://school.example.org/en/course/5 http://wiki.example.com/page/main
https://museum.example.org/de/612 http://science.example.com/articles/9.html https://weather.example.org/today http://maps.example.com/city/4
https://www.thther.example.org/en/685 http://blog.ththan.example.com/en/474.html https://m.therou.example.com/en/853 http://therha.example.org/fr/414
https://tiontion.example.com/es/384 http://ththed.example.org/en/453 https://thering.example.com/en/328 http://www.onthe.example.org/en/728
http://m.thanen.example.com/en/403.html http://tionble.example.org/es/53/ https://nder.example.com/de/77 https://blog.rethe.example.org/en/12/
https://books.example.com/en/148.html http://garden.example.org/plants https://history.example.com/timeline http://health.example.org/advice/sleep
""".split()),
]

BUCKETS, SIZES, PENALTY = 1024, (3, 4), 0.002


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, with A-Z in lower case; empty without one."""
    at = F.instr(url, "://")
    host = F.substring_index(F.substring_index(F.substring_index(F.substr(url, at + 3), "/", 1), "?", 1), "#", 1)
    return F.when(at > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end; empty without "://"."""
    at = F.instr(url, "://")
    after = F.substring_index(F.substring_index(F.substr(url, at + 3), "?", 1), "#", 1)
    slash = F.instr(after, "/")
    return F.when((at > 0) & (slash > 0), F.substr(after, slash)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, else null."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        fits.append(F.when(((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}")), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def buckets_of(host: Column, path: Column, buckets: int = BUCKETS, sizes: tuple[int, ...] = SIZES) -> Column:
    """Hashed n-grams of host and path, each between its own edge signs; an n-gram counts once for each place."""
    def grams(text: Column, size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substr(text, i, F.lit(size))), F.lit(buckets)).cast("int"))

    edged = [F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit("<"), path, F.lit(">"))]
    return F.concat(*[grams(t, n) for t in edged for n in sizes])


def linear(found: Column, weights: list[float], bias: float) -> Column:
    """Bias plus the mean weight of the n-grams, scaled by the square root of their number."""
    table = F.array(*[F.lit(w) for w in weights])
    total = F.aggregate(found, F.lit(0.0), lambda a, b: a + F.get(table, b))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def fit(spark: SparkSession, labelled: list[tuple[str, int]] | None = None, buckets: int = BUCKETS) -> tuple[list[float], float]:
    """Weights and bias of the regression, fitted by Spark to the labelled table; only these numbers reach the driver."""
    table = spark.createDataFrame([(u, float(y)) for u, y in labelled or LABELLED], "url string, label double")
    found = table.select("label", buckets_of(host_of(F.col("url")), path_of(F.col("url")), buckets).alias("grams"))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(buckets - 1)), lambda b: F.size(F.filter(F.col("grams"), lambda g: g == b)) / F.sqrt(F.size("grams").cast("double"))
    )
    model = LogisticRegression(regParam=PENALTY, maxIter=100, standardization=False).fit(found.coalesce(1).select("label", array_to_vector(counts).alias("features")))
    return [round(float(w), 9) for w in model.coefficients], round(float(model.intercept), 9)


def judge(pages: DataFrame, weights: list[float], bias: float, url: str = "url", rules: dict[str, str] = RULES) -> DataFrame:
    """``row`` (the input's columns), ``host``, ``path``, ``rule``, ``score`` (probability to block) and ``verdict``."""
    parts = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"))
    cut = parts.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = cut.select("row", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("rule"), buckets_of(F.col("host"), F.col("path"), len(weights)).alias("grams"))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear(F.col("grams"), weights, bias)))
    scored = ruled.select("row", "host", "path", "rule", score.alias("score"))
    ruling = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()]) if rules else F.lit(None).cast("string")
    return scored.select("*", F.coalesce(ruling, F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, *fit(spark)).select("row.page_id", "host", "path", "rule", "verdict", "score")
