"""URL filters: rules on hosts and paths, and for all other URLs a logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.small import small_table

ALLOW, BLOCK = "allow", "block"
#: Lengths of the n-grams, and the number of hashed features.
GRAM_SIZES = (3, 4, 5)
FEATURES = 1 << 16
RIDGE = 1e-3
STEPS = 60
THRESHOLD = 0.5
#: Up to so many rules are tested row by row; more are joined by host.  Both give the same rows.
RULES_IN_PLAN = 500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null and other texts."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null and other texts."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _grams_of(text: Column, mark: str) -> Column:
    """The n-grams of ``text``, with marks of its kind and length; each length is one pass over the text."""
    found = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in GRAM_SIZES]
    return F.transform(F.flatten(F.array(*found)), lambda gram: F.concat(F.lit(mark), gram))


def grams(host: Column, path: Column) -> Column:
    """The n-grams of host and path in one list; ``^`` and ``$`` stand at the edges of a host, ``$`` at the end of a path."""
    edged = F.when(host == "", "").otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    ended = F.when(path == "", "").otherwise(F.concat(F.translate(path, _UPPER, _LOWER), F.lit("$")))
    return F.concat(_grams_of(edged, "h:"), _grams_of(ended, "p:"))


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def fit(labelled: DataFrame, url_column: str = "url", label_column: str = "blocked") -> PipelineModel | None:
    """A logistic regression with a ridge on the presence of hashed n-grams, from URLs marked 1 (block) or 0 (allow).

    Null marks and null URLs are left out.  None if one of the marks does not occur.  The fit is a Spark job over
    ``labelled``, so its size is not bounded by the driver.
    """
    url = F.col(url_column)
    known = labelled.where(url.isNotNull() & F.col(label_column).isin(0, 1)).select(
        grams(host_of(url), path_of(url)).alias("grams"), F.col(label_column).cast("double").alias("label")
    )
    if known.select("label").distinct().count() < 2:
        return None
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    logistic = LogisticRegression(regParam=RIDGE, standardization=False, maxIter=STEPS, threshold=THRESHOLD)
    return Pipeline(stages=[hashing, logistic]).fit(known)


def scored(df: DataFrame, model: PipelineModel | None, host: str, path: str, name: str) -> DataFrame:
    """``df`` with ``name``: the probability, 0 to 1, that a URL of this host and path is blocked; 0 without a model."""
    if model is None:
        return df.withColumn(name, F.lit(0.0))
    columns = df.columns
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), grams(F.col(f"`{host}`"), F.col(f"`{path}`")).alias("grams"))
    out = model.transform(row)
    return out.select(*[F.col("row").getField(c).alias(c) for c in columns], vector_to_array("probability")[1].alias(name))


def _split(rule: str) -> tuple[str, str]:
    at = rule.find("/")
    return (rule, "") if at < 0 else (rule[:at], rule[at:])


def _ordered(rules: Mapping[str, str]) -> list[tuple[str, str, str, str]]:
    """``rule, .host, path, verdict``: longest rule first, of equal lengths the smaller text."""
    order = sorted(rules, key=lambda rule: (-len(rule), rule))
    return [(rule, f".{_split(rule)[0]}", _split(rule)[1], rules[rule]) for rule in order]


def with_rules(df: DataFrame, rules: Mapping[str, str], host: str = "host", path: str = "path", name: str = "rule") -> DataFrame:
    """``df`` with ``name``: the longest rule that fits, else null.

    A rule ``host/path`` fits its host and all subdomains of it, if the path starts with the rule's.  Of equally
    long ones the smaller text counts.
    """
    own = F.concat(F.lit("."), F.col(f"`{host}`"))
    if len(rules) <= RULES_IN_PLAN:
        if not rules:
            return df.withColumn(name, F.lit(None).cast("string"))
        known = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(dot).alias("dot"), F.lit(start).alias("start")) for rule, dot, start, _ in _ordered(rules)])
        fitting = F.filter(known, lambda r: F.endswith(own, r["dot"]) & F.startswith(F.col(f"`{path}`"), r["start"]))
        return df.withColumn(name, F.get(fitting, F.lit(0))["rule"])
    made = [(place, rule, dot, start) for place, (rule, dot, start, _) in enumerate(_ordered(rules))]
    table = small_table(df.sparkSession, made, "place int, rule string, dot string, start string")
    parts = max(dot.count(".") for _, _, dot, _ in made)  # no rule's host has more parts
    urls = df.select(F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path")).distinct()
    labels = F.slice(F.split("host", r"\."), -F.least(F.lit(parts), F.size(F.split("host", r"\."))), F.lit(parts))
    tails = F.transform(labels, lambda _, i: F.concat(F.lit("."), F.array_join(F.slice(labels, i + 1, F.lit(parts)), ".")))
    looked = urls.select("host", "path", F.explode(tails).alias("dot")).join(table, "dot").where(F.startswith("path", F.col("start")))
    best = looked.groupBy("host", "path").agg(F.min_by("rule", "place").alias(name))
    keys = (F.col(f"left.`{host}`") == F.col("right.host")) & (F.col(f"left.`{path}`") == F.col("right.path"))
    return df.alias("left").join(best.alias("right"), keys, "left").select("left.*", F.col(f"right.`{name}`"))


def judged(
    pages: DataFrame, rules: Mapping[str, str], model: PipelineModel | None, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row: the rule's verdict, else the model's.

    Null URLs, and those without ``://``, have an empty host and path; the model judges them by its bias.  Ids may
    be null or repeat.  Other columns of ``pages`` are not read.  With up to ``RULES_IN_PLAN`` rules nothing is shuffled.
    """
    url = F.col(url_column).cast("string")
    parts = pages.select(F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = scored(with_rules(parts, rules), model, "host", "path", "score")
    blocked = [rule for rule, verdict in rules.items() if verdict == BLOCK]
    by_rule = F.when(F.col("rule").isin(blocked), BLOCK).otherwise(ALLOW)
    by_model = F.when(F.col("score") >= THRESHOLD, BLOCK).otherwise(ALLOW)
    verdict = F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_model)
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
