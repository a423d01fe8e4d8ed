"""URL filter: host and path rules first, then a trained verdict.

The verdict is a logistic regression on hashed character n-grams of host and path. It
is trained from a small labelled URL table; scoring is a projection that runs where the
URLs lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.common import ASCII_LOWER, ASCII_UPPER

GRAM_SIZES = (3, 4, 5)
HASH_SLOTS = 1 << 16
#: Labelled rows that training reads at most; they are fitted by a few tasks.
MOST_LABELLED = 100_000
#: Rules are an expression evaluated per URL, so their number is bounded.
MOST_RULES = 1_000

#: The rules of the crawl, longest first wins. (rule, action)
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: Words that the hosts of the labelled table are built from: unwanted sites by subject, then ordinary ones.
UNWANTED = (
    "casino poker betting bets jackpot roulette slots lottery wager bingo "
    "adult porn xxx sex escort cams nude erotic hookup "
    "pills viagra pharma meds steroids slimming painkiller "
    "loans payday crypto doubler forex profit giveaway prize winner win free cheap replica cash "
    "warez crack keygen torrent malware phishing trojan hacked "
    "ads adserver popup banner tracker track clicks pixel traffic redirect "
    "spam backlinks linkfarm bulkmail contentfarm"
).split()
ORDINARY = (
    "news science museum library university school weather health travel recipes garden history music sports research "
    "journal forum archive wiki developer physics government council gallery photo mountain river bakery theatre orchestra "
    "woodwork astronomy geology railway harbour bookshop cinema language teaching cooking cycling sailing chess poetry "
    "novels economics medicine nursing farming forest climate energy transport housing justice parliament election charity "
    "hospital kindergarten community software compiler network database weekend holiday village castle church island coast "
    "desert winter summer spring autumn painting sculpture pottery knitting carpenter plumber architect engineer biology "
    "chemistry algebra geometry statistics grammar dictionary atlas map hiking running swimming tennis football cricket"
).split()
#: Second words of hosts, the same for both classes, so they tell nothing.
COMPANIONS = "online hub world city club shop times centre daily local guide now best live zone point house net".split()
#: Ordinary sites are the rule, so an unknown host should pass: they get more hosts a word.
UNWANTED_HOSTS, ORDINARY_HOSTS = 8, 18
SUBDOMAINS = ("", "www.", "m.", "blog.", "", "cdn.")
#: Endings reserved for examples and tests, so that no real site is named.
ENDINGS = ("test", "example", "co.test", "web.example", "invalid", "info.test")
#: Paths by class, and those that both have. Half of the URLs take one of their class.
UNWANTED_PATHS = ("/bonus/{n}", "/signup-bonus", "/buy-now?id={n}", "/click?to={n}", "/pop/{n}", "/out.php?u={n}", "/hot/{n}.html", "/win/{w}")
ORDINARY_PATHS = ("/articles/{n}", "/about", "/docs/{w}", "/events/{n}", "/staff/", "/library/{n}.html", "/contact", "/archive/{w}")
SHARED_PATHS = ("/", "/en/{n}", "/de/{n}", "/fr/{n}.html", "/es/{n}/", "/index.html", "/{n}?page=2")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table, ``url, label`` (1 for unwanted): each word in several hosts, half of the URLs with a path of their class."""
    rows = []
    classes = ((1.0, UNWANTED, UNWANTED_HOSTS, UNWANTED_PATHS), (0.0, ORDINARY, ORDINARY_HOSTS, ORDINARY_PATHS))
    for label, names, hosts, own in classes:
        for i, name in enumerate(names):
            for j in range(hosts):
                n = i * hosts + j
                with_word = COMPANIONS[(i + 5 * j) % len(COMPANIONS)]
                host = (f"{name}-{with_word}", f"{with_word}-{name}", f"{name}{with_word}")[j % 3]
                paths = own if (i + j) % 2 else SHARED_PATHS
                path = paths[(i + j // 2) % len(paths)].format(n=37 * n % 9973, w=with_word)
                rows.append((f"https://{SUBDOMAINS[(i + j) % 6]}{host}.{ENDINGS[(2 * i + j) % 6]}{path}", label))
    return spark.createDataFrame(rows, "url string, label double")


def split_by_host(labelled: DataFrame, folds: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows to train from, and rows held out: those of the hosts whose crc32 leaves 0 on division by ``folds``."""
    out = F.pmod(F.crc32(host(F.col("url"))), F.lit(folds)) == 0
    return labelled.where(~out), labelled.where(out)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    name = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(name, ASCII_UPPER, ASCII_LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct ``rule, action``; NULL where none does.

    A rule fits its host and all hosts below it if the path starts with the rule's. Of
    rules of one length the first in the sequence wins.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    choice = F.lit(None).cast("struct<rule:string,action:string>")
    for rule, action in sorted(reversed(rules), key=lambda r: len(r[0])):
        at = (rule + "/").index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        choice = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(choice)
    return choice


def _grams(text: Column, mark: str, sizes: Sequence[int]) -> Column:
    """Character n-grams of a text with ends marked; the mark tells host from path."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(framed) - F.lit(n - 1), F.lit(1)))
        grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(framed, i, n)))
        return F.when(F.length(framed) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of_size(n) for n in sizes])


def features(urls: DataFrame, host: str = "host", path: str = "path", sizes: Sequence[int] = GRAM_SIZES) -> DataFrame:
    grams = urls.withColumn("_grams", F.concat(_grams(F.col(host), "h:", sizes), _grams(F.col(path), "p:", sizes)))
    hashed = HashingTF(numFeatures=HASH_SLOTS, inputCol="_grams", outputCol="_features", binary=True).transform(grams)
    return hashed.drop("_grams")


def train(labelled: DataFrame, most: int = MOST_LABELLED) -> LogisticRegressionModel:
    """The model of a labelled table ``url, label``; rows without either teach nothing.

    Of a table with more than ``most`` rows, those whose URL hashes lowest are used.
    """
    rows = labelled.where(F.col("url").isNotNull() & F.col("label").isNotNull())
    rows = rows.select("url", F.col("label").cast("double").alias("label"))
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(most)
    ready = features(rows.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "label"))
    fit = LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.002, maxIter=60, standardization=False)
    return fit.fit(ready.select("_features", "label").coalesce(1))


def judge(
    pages: DataFrame,
    model: LogisticRegressionModel,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score``.

    ``score`` is the probability that the URL is unwanted. A rule's verdict stands; else
    a score above ``threshold`` blocks. A NULL URL or one without ``://`` has an empty
    host and path, which no rule fits, and is scored like any other. Columns other than
    the id and the URL are ignored, whatever their names. Rows that repeat a URL are judged
    alike, each with a row of its own; a URL of any length is read whole; an empty table
    gives an empty result.
    """
    parts = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("_url")).select(
        "page_id", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path")
    )
    scored = model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("").transform(features(parts))
    ruled = scored.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "score", F.round(vector_to_array("_p")[1], 6)
    )
    return ruled.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.action"), F.when(F.col("score") > threshold, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
