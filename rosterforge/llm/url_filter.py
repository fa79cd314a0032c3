"""URL verdicts: written rules first, then logistic regression on hashed character n-grams.

A URL's host and path are cut into character 3- and 4-grams (with marks at both
ends), hashed to buckets apart for host and path.  The weights are learned by
stochastic gradient steps over a small labelled table of URLs; the whole
training is one SQL expression over one row (nested `aggregate`), bounded by
`MOST_LABELLED` rows.  Judging is one pass over the pages without a shuffle.
Everything is DataFrame functions: no Python runs on the executors.

Characters are split once and addressed by position, so a very long URL costs in
proportion to its length.

Defined cases: a null URL or one without `://` has an empty host and path and no
n-grams, and gets the verdict of the bias alone; repeated pages are judged each;
an empty table gives an empty result; with no labelled row of one of the two
classes everything that no rule fits is allowed; columns other than `page_id`
and `url` play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1024
MOST_LABELLED = 10_000

# --- fixed values: the rules of the filter -----------------------------------
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# --- fixed values: the small labelled table (1: block) -------------------------
LABELLED = (
    (1, "http://casino-royal.example.net/en/bonus"), (1, "https://www.online-casino.example.com/play/1"),
    (1, "http://poker-stars-win.example.org/en/77"), (1, "https://m.lucky-slots.example.net/jackpot"),
    (1, "http://cheap-viagra.example.com/buy/3"), (1, "https://blog.best-pills.example.net/en/order"),
    (1, "http://discount-pharmacy.example.org/pills/9"), (1, "https://free-money-now.example.com/cash"),
    (1, "http://payday-loans.example.net/apply"), (1, "https://www.fast-loan.example.org/en/12"),
    (1, "http://xxx-videos.example.com/hot/5"), (1, "https://adult-cams.example.net/live"),
    (1, "http://replica-watches.example.org/cheap/2"), (1, "https://m.click-farm.example.com/go"),
    (1, "http://spam-links.example.net/fr/4"), (1, "https://link-farm.example.org/en/88"),
    (1, "http://win-prizes.example.com/claim"), (1, "https://blog.bet-now.example.net/odds/6"),
    (1, "http://cheap-meds.example.org/en/31"), (1, "https://www.casino-win.example.org/spin/8"),
    (1, "http://crack-keygen.example.com/download/7"), (1, "https://warez-torrents.example.net/get/15"),
    (1, "http://miracle-diet.example.org/pills"), (1, "https://hot-singles.example.com/meet/2"),
    (1, "http://spam-farm.example.net/page/64"), (1, "https://m.cheap-pills.example.com/es/19"),
    (1, "http://lottery-winner.example.net/claim/1"), (1, "https://www.seo-spam.example.org/backlinks"),
    (1, "http://bingo-bonus.example.com/free"), (1, "https://crypto-doubler.example.net/win/5"),
    (1, "http://ads-server.example.com/en/track/3"), (1, "https://ad-tracking.example.org/click/40"),
    (1, "http://www.tracker-ads.example.net/de/2"), (1, "https://free-bet.example.com/fr/11"),
    (1, "http://m.sports-bets.example.org/es/600"), (1, "https://adult-chat.example.com/en/23"),
    (1, "http://blog.adult-video.example.org/de/8"), (1, "https://www.spam-farming.example.net/en/901"),
    (1, "http://m.content-farm.example.org/fr/72"), (1, "https://casino-games.example.org/de/5"),
    (1, "http://blog.cheap-pill.example.net/fr/321"), (1, "https://free-casino.example.com/es/47"),
    (0, "http://www.library.example.org/en/catalog"), (0, "https://news.example.com/world/2021"),
    (0, "http://blog.gardening.example.net/en/214"), (0, "https://university.example.org/de/courses"),
    (0, "http://m.weather.example.com/fr/today"), (0, "https://www.museum.example.net/exhibits/7"),
    (0, "http://recipes.example.org/es/33"), (0, "https://docs.software.example.com/guide/install.html"),
    (0, "http://thereon.example.net/en/742"), (0, "https://blog.ingrent.example.com/fr/825"),
    (0, "http://www.stationer.example.org/de/511"), (0, "https://m.orient.example.net/en/673"),
    (0, "http://there.example.com/en/27"), (0, "https://blog.thistle.example.org/es/66"),
    (0, "http://www.nation.example.net/en/773"), (0, "https://m.heather.example.com/de/92"),
    (0, "http://history.example.org/en/1066"), (0, "https://science.example.net/articles/41"),
    (0, "http://www.travel.example.com/es/150"), (0, "https://blog.music.example.org/en/89"),
    (0, "http://townhall.example.net/en/notices"), (0, "https://www.school.example.com/fr/1920"),
    (0, "http://shore.example.org/en/453"), (0, "https://m.tionster.example.net/en/217"),
    (0, "http://books.example.com/en/825.html"), (0, "https://blog.handwork.example.org/de/311"),
    (0, "http://www.theatre.example.net/fr/48"), (0, "https://sports.example.com/en/results"),
    (0, "http://www.ththen.example.net/en/4017?page=2"), (0, "https://ththan.example.com/de/660#top"),
    (0, "http://blog.thtion.example.org/es/7102.html"), (0, "https://m.thonth.example.net/fr/58/"),
    (0, "http://m.thander.example.org/en/913"), (0, "https://www.hathorn.example.com/es/3480"),
    (0, "http://blog.shoreline.example.net/de/205"), (0, "https://eathen.example.org/fr/61.html"),
    (0, "http://www.wheat.example.com/en/58"), (0, "https://m.thither.example.net/es/1207"),
    (0, "http://m.rivers.example.org/en/70"), (0, "https://www.hospital.example.net/en/visit"),
)


@dataclass(frozen=True)
class UrlModel:
    """One weight per bucket (host buckets, then path buckets) and the bias."""

    weights: tuple[float, ...]
    bias: float


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(host, F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _grams(text: Column, side: int) -> Column:
    """Buckets of all 3- and 4-grams of a marked text; an empty text has none."""
    chars = F.concat(F.array(F.lit("\u0002")), F.split(text, ""), F.array(F.lit("\u0003")))

    def at(n: int) -> Column:
        last = F.size(chars) - n
        places = F.when((text != "") & (last >= 0), F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places, lambda i: (F.pmod(F.xxhash64(F.lit(side), *[chars[i + k] for k in range(n)]), F.lit(BUCKETS)) + side * BUCKETS).cast("int")
        )

    return F.concat(at(3), at(4))


def grams(host: Column, path: Column) -> Column:
    return F.struct(_grams(host, 0).alias("host"), _grams(path, 1).alias("path"))


# A side's n-grams weigh together as much however long it is; the path weighs half of the host.
SHARE = {"host": 1.0, "path": 0.5}


def _scale(side: str) -> str:
    return f"{SHARE[side]}D / sqrt(greatest(size(f.{side}), 1))"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: `url, label` with 1 for block."""
    rows = ", ".join(f"('{url}', {label})" for label, url in LABELLED)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def train(labelled: DataFrame, epochs: int = 40, rate: float = 2.0, decay: float = 1e-4) -> UrlModel:
    """Weights learned from `url, label` (0 or 1); at most `MOST_LABELLED` rows, in the order of a hash."""
    known = labelled.where(F.col("label").isin(0, 1)).select(
        F.col("label").cast("double").alias("y"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    known = known.distinct().orderBy(F.xxhash64("host", "path", "y"), "host", "path", "y").limit(MOST_LABELLED)
    width = 2 * BUCKETS
    found = grams(F.col("host"), F.col("path"))
    # one dense vector per labelled URL: the weight of its n-grams in each bucket, and 1 for the bias
    counted = known.select("y", "host", "path", found.alias("f")).select(
        "y",
        F.xxhash64("host", "path").alias("o"),
        F.expr(
            f"concat(transform(sequence(0, {BUCKETS - 1}), k -> size(filter(f.host, b -> b = k)) * {_scale('host')}),"
            f" transform(sequence({BUCKETS}, {width - 1}), k -> size(filter(f.path, b -> b = k)) * {_scale('path')}), array(1D))"
        ).alias("x"),
    )
    held = counted.agg(
        F.sort_array(F.collect_list(F.struct("o", "y", "x"))).alias("rows"), F.min("y").alias("low"), F.max("y").alias("high")
    )
    # the error of a row is worked out once, then spread over the weights
    step = (
        "aggregate(rows, w, (w, r) -> transform(array(r.y - 1 / (1 + exp(-least(greatest("
        "aggregate(zip_with(w, r.x, (a, b) -> a * b), 0D, (s, p) -> s + p), -60D), 60D)))),"
        f" e -> zip_with(w, r.x, (v, x) -> v + {rate}D * (e * x - {decay}D * v)))[0])"
    )
    trained = held.select(
        "low", "high", F.expr(f"aggregate(sequence(1, {epochs}), array_repeat(0D, {width + 1}), (w, i) -> {step})").alias("w")
    ).first()
    if trained["low"] is None or trained["low"] == trained["high"]:
        return UrlModel((0.0,) * width, -1.0)
    return UrlModel(tuple(trained["w"][:-1]), trained["w"][-1])


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1], r[0])):  # the longest decides last
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, model: UrlModel, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """`page_id, host, path, rule, verdict, score` of every page; score is the model's probability of block."""
    weights = F.lit(list(model.weights))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    found = parts.select("page_id", "host", "path", rule.alias("rule"), by_rule.alias("by_rule"), grams(F.col("host"), F.col("path")).alias("f"))
    z = F.lit(model.bias)
    for side in ("host", "path"):
        z += F.aggregate(f"f.{side}", F.lit(0.0), lambda s, b: s + weights[b]) * F.expr(_scale(side))
    scored = found.select("page_id", "host", "path", "rule", "by_rule", (1 / (1 + F.exp(-z))).alias("score"))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score",
    )
