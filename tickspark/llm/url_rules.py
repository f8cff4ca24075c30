"""Operator 5: URL filter of listed rules and mined association rules.

Listed (host, path) rules decide first. For the rest, Spark's FP-growth mines token
combinations of labelled URLs; combinations that imply ``block`` with enough
confidence and support become rules, and pages match them through an inverted index
that files each rule under its rarest token. Each labelled source is mined by
itself, so that a large noisy one cannot outvote a small clean one.

Defined cases: null URLs and URLs without ``://`` have an empty host and path and are
allowed; without labels nothing is mined; repeated pages each keep a row; a URL's
token counts once. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import stored

#: Listed rules (verdict, host, path prefix); the longest that fits decides.
LISTED = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_SUPPORT, MIN_CONFIDENCE, MIN_COUNT, MAX_LENGTH = 0.0, 0.8, 8, 3
BROADCAST_RULES = 20_000
#: Small labelled table of URLs: token pairs that name unwanted sites, and ordinary
#: ones. Fixed values; ``seed_urls`` sets them into a few URL shapes.
UNWANTED = ("spam-mailer", "cheap-meds", "casino-royal", "bets-bonus", "ads-popup", "adult-dating", "online-casino", "cheap-viagra",
            "free-porn", "adult-cams", "win-jackpot", "sports-bets", "payday-loans", "replica-watches", "buy-followers",
            "spam-links", "ads-click", "track-pixel", "pills-store", "poker-bonus")
ORDINARY = ("daily-news", "city-library", "open-science", "river-museum", "green-garden", "maths-notes", "history-online",
            "town-council", "bird-watchers", "free-software", "win-chess", "music-school", "online-courses", "book-store",
            "farm-shop", "adult-education", "track-cycling", "village-links", "health-journal", "travel-diary")
#: At least MIN_COUNT shapes, so that every name alone reaches the support.
_SHAPES = ("https://www.{}.example.com/en/1", "http://{}.example.org/de/2.html", "https://m.{}.example.net/fr/3?page=2",
           "https://blog.{}.example.com/es/4/", "http://{}.example.net/it/5", "https://shop.{}.example.org/pt/6",
           "https://www.{}.example.org/nl/7.html", "http://news.{}.example.com/pl/8/")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest listed rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: host parts as h:..., path parts as p:..., numbers as one sign."""
    def of(col, sign):
        words = F.split(F.regexp_replace(F.lower(col), "[0-9]+", "0"), r"[^\p{L}0-9]+")
        return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(sign), w))
    return F.array_distinct(F.concat(of(host, "h:"), of(path, "p:")))


def seed_urls(spark: SparkSession) -> DataFrame:
    """(url, label) of the small labelled table; label 1 is to be blocked."""
    rows = [(shape.format(name), int(names is UNWANTED)) for names in (UNWANTED, ORDINARY) for name in names for shape in _SHAPES]
    return spark.createDataFrame(rows, "url string, label int")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_count: int = MIN_COUNT, max_length: int = MAX_LENGTH) -> DataFrame:
    """(antecedent, support, confidence) of mined rules that imply ``block``, from
    (url, label) rows. Tokens in fewer than ``min_count`` rows are left out before mining,
    however many rows there are; ``min_support`` asks for a share of the rows besides."""
    items = labelled.where("url is not null and label is not null").select(
        url_tokens(host_of(F.col("url")), path_of(F.col("url"))).alias("items"), "label")
    rows = items.withColumn("items", F.when(F.col("label") > 0, F.array_append("items", F.lit("=block"))).otherwise(F.col("items")))
    total, blocked = rows.agg(F.count("*"), F.count_if(F.col("label") > 0)).first()
    if not blocked:
        return labelled.sparkSession.createDataFrame([], "antecedent array<string>, support double, confidence double")
    support = max(min_support, min_count / total)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(rows.select("items"))
    return (model.associationRules.where((F.col("consequent") == F.array(F.lit("=block"))) & (F.size("antecedent") <= max_length))
            .select("antecedent", "support", "confidence"))


def judge_urls(pages: DataFrame, labelled: list[DataFrame], rules=LISTED, id_col: str = "page_id", url_col: str = "url",
               **mining) -> DataFrame:
    """page_id, host, path, rule, verdict, matched (mined rule, if any) of every page."""
    spark = pages.sparkSession
    mined = None
    for source in labelled:
        got = mine_rules(source, **mining)
        mined = got if mined is None else mined.unionByName(got)
    if mined is None:
        mined = spark.createDataFrame([], "antecedent array<string>, support double, confidence double")
    ranked = mined.groupBy(F.array_sort("antecedent").alias("antecedent")).agg(
        F.max("confidence").alias("confidence"), F.max("support").alias("support"))
    # A rule is filed under its token that the fewest rules have.
    spread = ranked.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    keyed = (ranked.withColumn("token", F.explode("antecedent")).join(spread, "token")
             .groupBy("antecedent").agg(F.first("confidence").alias("confidence"), F.min(F.struct("n", "token"))["token"].alias("token")))
    index = stored(keyed.select("token", "antecedent", "confidence").coalesce(1), "url-rules")
    index = F.broadcast(index) if index.count() <= BROADCAST_RULES else index
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    src = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
                       host.alias("host"), path.alias("path")).withColumn("tokens", url_tokens(F.col("host"), F.col("path")))
    hits = src.withColumn("token", F.explode_outer("tokens")).join(index, "token", "left")
    fits = F.size(F.array_except("antecedent", "tokens")) == 0
    best = F.max(F.when(fits, F.struct("confidence", F.array_join("antecedent", "+").alias("name"))))["name"]
    out = hits.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"),
                                  best.alias("matched"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("matched").isNotNull(), "block").otherwise("allow")).alias("verdict"), "matched")
