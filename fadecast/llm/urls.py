"""URL filter: rules first, then logistic regression on hashed character n-grams of host
and path. Everything runs in the JVM: features are array expressions, the model is
``pyspark.ml``'s, trained once from a small labelled table of URLs.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

SIZES = (3, 4)  # characters of an n-gram
FEATURES = 1 << 18

# The rules of the query, domain and path prefix, with their verdicts.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}

# URLs labelled by hand. Blocked: gambling, adult, pills, loans, link farms,
# trackers and downloads of binaries. Allowed: articles, documentation, reference, forums.
BLOCKED = """
http://best-casino-bonus.example/slots/free-spins
http://online-casino.example/poker/jackpot-win
http://www.bet-win-bet.example/sport/odds?ref=aff
https://slots.example/casino/bonus-code.html
http://jackpot-city.example/free-spins?aff=12
http://hot-adult-videos.example/xxx/free
http://xxx-tube.example/porn/watch?id=3
https://adult-dating.example/hot-singles/near-you
http://live-sex-cams.example/xxx/chat
http://porn-pics.example/gallery/xxx/12
http://cheap-pills.example/viagra/buy-now
http://pharmacy-discount.example/cialis/no-prescription
https://buy-viagra-online.example/cheap/pills
http://weight-loss-pills.example/miracle/buy
http://payday-loans.example/cash/instant-approval
http://fast-cash-loan.example/apply-now?aff=77
https://credit-repair-loan.example/cheap/offer
http://replica-watches.example/cheap/rolex
http://cheap-replica-bags.example/buy/gucci
http://seo-link-farm.example/backlinks/buy
http://free-backlinks.example/directory/submit-link
http://ads.tracker.example/click?campaign=3&aff=9
http://adserver.example/banner/popup.js
https://track.click-ads.example/redirect?url=offer
http://pixel.tracker.example/popup/ad.gif
http://free-download-crack.example/keygen/serial.exe
http://warez.example/crack/download.zip
http://torrent-free.example/download/movie.torrent
http://mp3-free-download.example/serial/crack.rar
http://win-free-iphone.example/prize/claim-now
http://lottery-winner.example/claim/prize?id=1
http://make-money-fast.example/crypto/double-bitcoin
https://bitcoin-doubler.example/invest/profit-now
http://forex-profit.example/signals/buy-now
http://login-verify-account.example/secure/update.php
http://spam-blog-network.example/post/1
http://link-spam.example/farm/links
http://content-farm.example/spun/articles
http://spam-links-farm.example/mass/posts
http://casino-winners.example/win/big
http://win-casino-online.example/spins
"""
ALLOWED = """
https://www.daily-news.example/politics/2021/03/election-results.html
https://news.example/world/article/12345
https://blog.example/posts/how-to-cook-rice
http://www.cooking.example/recipes/bread.html
https://docs.library.example/en/guide/install.html
https://docs.project.example/api/reference/index.html
https://wiki.example/wiki/history_of_science
https://en.encyclopedia.example/wiki/mathematics
http://www.university.example/department/physics/lecture-notes.html
https://school.example/courses/biology/week-2
https://library.example/catalog/books/4711
https://museum.example/exhibitions/roman-art
https://www.city.example/en/services/water
http://www.gov.example/publications/report-2019.html
https://health.example/articles/diabetes-overview
http://www.hospital.example/patients/visiting-hours
https://forum.example/topic/3321/question-about-python
https://questions.example/questions/88/how-do-i-sort-a-list
https://code.example/project/readme.html
https://software.example/manual/chapter-3
https://science.example/journal/volume-12/paper-4
https://www.weather.example/forecast/berlin
https://travel.example/guides/lisbon
http://www.garden.example/plants/tomato.html
https://books.example/reviews/novel-of-the-year
https://music.example/interviews/composer
https://www.sports-club.example/news/match-report
https://history.example/articles/middle-ages
https://language.example/lessons/grammar/3
https://m.magazine.example/culture/film-review
https://www.economy.example/analysis/markets-today
https://kids.example/stories/the-fox
https://radio.example/programmes/morning-show
http://www.church.example/community/events
https://research.example/en/publications/12
https://anderson.example/en/7012
https://thornton.example/about.html
http://eastenders.example/de/318
https://hannover.example/de/aktuell/4410.html
https://leon-etranger.example/fr/culture/22
http://reading-other.example/es/noticias/981
https://northern.example/fr/561/
https://meridian.example/es/77
https://riverside.example/en/9921.html
https://atlantis.example/contact
"""

# A site's front names say nothing; every labelled URL counts under each.
FRONTS = ("", "www.", "m.", "blog.")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or if null."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls. The rules are an expression:
    as many branches as the given dictionary has, the longest first, ties by name."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        domain, slash, start = r.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule = F.when(fits, F.lit(r)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[r])).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they stand."""


    def runs(mark: str, text: Column, n: int) -> Column:
        at = F.sequence(F.lit(1), F.length(text) - (n - 1))
        found = F.transform(at, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
        return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<string>"))

    ends = {"h": F.concat(F.lit("^"), host, F.lit("$")), "p": F.concat(path, F.lit("$"))}
    return F.concat(*(runs(mark, text, n) for mark, text in ends.items() for n in SIZES))


def labelled(spark: SparkSession) -> DataFrame:
    """``url, label``: the URLs above, 1 for blocked ones."""
    known = [(u, 1) for u in BLOCKED.split()] + [(u, 0) for u in ALLOWED.split()]
    rows = [(u.replace("://www.", "://").replace("://m.", "://").replace("://", f"://{f}"), y) for u, y in known for f in FRONTS]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y}D)" for u, y in rows) + " AS t(url, label)")


def train(urls: DataFrame) -> PipelineModel:
    """A model from ``urls (url, label)``; the table is small and goes to one partition, so
    that sums do not depend on the cluster."""
    host, path = host_and_path(F.col("url"))
    rows = urls.filter("url is not null and label is not null").coalesce(1).select(grams(host, path).alias("grams"), "label")
    return Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True),
            LogisticRegression(maxIter=100, regParam=0.01, tol=1e-8, standardization=False),
        ]
    ).fit(rows)


def judge(pages: DataFrame, rules: dict[str, str], model: PipelineModel) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row of ``pages (page_id, url)``.

    ``score`` is the model's probability of a block, which decides from 0.5 on where no
    rule fits. A null url or one without ``://`` has an empty host and path; the model
    judges it like any other. Hosts and paths of any length are used whole. Repeated rows
    get equal results; an empty table gives an empty table; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), grams(F.col("host"), F.col("path")).alias("grams"))
    score = vector_to_array("probability").getItem(1)
    return model.transform(rows).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.round(score, 6).alias("score"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages").select("page_id", "url"), RULES, train(labelled(spark)))
