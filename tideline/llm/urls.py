"""URL filter: longest matching rule, else logistic regression on character n-grams.

Everything is column expressions and Spark ML.  A url's host and path become
n-grams of 3 to 5 characters, marked by their part, with edges marked too;
``HashingTF`` gives them places and a logistic regression, trained from a small
labelled url table, gives the verdict where no rule fits.  No row moves between
tasks, so hosts of any size are alike.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZES = (3, 4, 5)
PLACES = 1 << 14

# Names that mark unwanted sites, and ordinary ones.
UNWANTED = (
    "casino win bets betting poker jackpot slots lottery pills pharma viagra cheap-meds "
    "adult xxx porn cams escort nude ads track tracker adserver clicks popunder banner "
    "spam farm linkfarm seo-links malware phishing warez cracked keygen torrent loans "
    "free-money get-rich miracle replica"
).split()
ORDINARY = (
    "news library university garden travel science history museum recipes weather school "
    "health sports music theatre books archive forum wiki docs code gazette harbour village "
    "river mountain hotel market kitchen letters atlas journal observatory orchard station "
    "council research writing theory answers nation other northern western"
).split()
PATHS = ("/", "/en/12", "/de/340.html", "/fr/7/", "/es/81", "/index.html", "/2021/05/story", "/a/b")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label) with 1 for unwanted: each name alone, with a prefix and joined to its neighbour."""
    rows = []
    for label, names in ((1.0, UNWANTED), (0.0, ORDINARY)):
        for i, name in enumerate(names):
            other = names[(i + 7) % len(names)]
            for j, host in enumerate((name, f"{name}-{other}", f"{name}{other}", f"{other}-x")):
                lead = ("", "www.", "blog.", "m.")[(i + j) % 4]
                ending = ("com", "net", "org")[(i + 2 * j) % 3]
                path = PATHS[(i + 3 * j) % len(PATHS)]
                rows.append((f"https://{lead}{host}.example.{ending}{path}", label))
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    place = F.locate("://", url)
    rest = F.when(place > 0, url.substr(place + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, NULL if none does.

    A rule (host, path, verdict) fits its host and all subdomains if the url's
    path starts with the rule's.  Of equally long rules the first one counts.
    The rules are few (a list in code), hence one CASE.
    """
    out = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = (
            (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        ) & F.startswith(path, F.lit(rule_path))
        told = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, told) if out is None else out.when(fits, told)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def grams(letters: Column, part: str) -> Column:
    """Marked n-grams from the array of a text's characters."""
    def of(n: int) -> Column:
        places = F.sequence(F.lit(0), F.size(letters) - n)
        cut = F.transform(
            places, lambda i: F.concat(F.lit(part), *[letters[i + j] for j in range(n)])
        )
        return F.when(F.size(letters) >= n, cut).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[of(n) for n in SIZES]))


def with_features(urls: DataFrame, host: str, path: str, out: str) -> DataFrame:
    # characters are cut once, as columns of their own, so that the work is linear in the url
    letters = {
        f"{out}_{c}": F.split(F.concat(F.lit("^"), F.col(c), F.lit("$")), "") for c in (host, path)
    }
    both = F.concat(grams(F.col(f"{out}_{host}"), "h"), grams(F.col(f"{out}_{path}"), "p"))
    told = urls.withColumns(letters).withColumn(f"{out}_grams", both).drop(*letters)
    hashed = HashingTF(
        inputCol=f"{out}_grams", outputCol=out, numFeatures=PLACES, binary=True
    ).transform(told)
    return hashed.drop(f"{out}_grams")


def train(labelled: DataFrame, ridge: float = 0.005) -> LogisticRegressionModel:
    """Model of a small table (url, label 0 or 1); rows without a label are left out."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.filter(F.col("label").isin(0.0, 1.0)).select(
        F.col("label").cast("double").alias("label"), host.alias("__host"), path.alias("__path")
    ).coalesce(1)
    rows = with_features(rows, "__host", "__path", "__features")
    return LogisticRegression(
        featuresCol="__features", labelCol="label", regParam=ridge, maxIter=40, standardization=False
    ).fit(rows)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = (),
    labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row: id, host, path, rule, verdict (allow or block), score.

    ``score`` is the model's probability of an unwanted url; the verdict is the
    rule's, else block from ``threshold`` on.  NULL, empty and urls without
    ``://`` have empty host and path and are judged by the model like any other.
    ``labelled``: (url, label), the built-in table if None.  An empty table
    gives an empty result; other columns are ignored.
    """
    model = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    model.setFeaturesCol("__features").setProbabilityCol("__probability")
    model.setRawPredictionCol("__raw").setPredictionCol("__prediction")
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(
        F.col(id_col).alias("__id"), host.alias("host"), path.alias("path")
    )
    told = model.transform(with_features(urls, "host", "path", "__features"))
    found = longest_rule(F.col("host"), F.col("path"), rules)
    score = vector_to_array("__probability")[1]
    return told.select(
        F.col("__id").alias(id_col), "host", "path", found["rule"].alias("rule"),
        F.coalesce(
            found["verdict"], F.when(score >= threshold, "block").otherwise("allow")
        ).alias("verdict"),
        score.alias("score"),
    )
