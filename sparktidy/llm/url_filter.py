"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule judges are the labelled ones.  A sample of them (about ``sample`` rows at most)
trains the trees and gives the suffix statistics: per last host label, the smoothed share of blocked
URLs.  It is chosen by hash among the distinct URLs, with a chance and a weight by their number of rows:
a URL of many rows is one row of the sample, weighted by all its rows, and crowds out none.  All features are built-in expressions; trees come from ``pyspark.ml``.

Nulls and texts without ``://`` have an empty host and path, match no rule and get the method's
verdict.  Without both kinds of label no tree can be grown, and the verdict is ``default``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktidy.llm._frames import sample_by_count
from sparktidy.workspace import stage

ADDED = ("host", "path", "rule", "verdict", "block_score")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host suffix followed by a path prefix, like ``example.com/en/``."""

    action: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        domain, _, rest = self.text.partition("/")
        inside = (host == domain) | F.endswith(host, F.lit("." + domain))
        return inside & F.startswith(path, F.lit("/" + rest if "/" in self.text else ""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) after the first ``://``; path up to ``?`` or ``#``; both empty without it."""
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def judge_by_rules(df: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``rule_action`` of the longest fitting rule."""
    host, path = host_and_path(F.col(url))
    out = df.withColumns({"host": host, "path": path})
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the longest is asked first, then the first given
        fits = r.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        action = F.when(fits, F.lit(r.action)).otherwise(action)
    return out.withColumns({"rule": rule, "rule_action": action})


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    n = F.length(text)
    size = F.greatest(n, F.lit(1)).cast("double")
    share = lambda kept: (_count(text, kept) / size)
    entropy = F.aggregate(
        F.array_distinct(F.split(text, "")),
        F.lit(0.0),
        lambda acc, c: acc
        + F.when(c == "", 0.0).otherwise(
            -((n - F.length(F.replace(text, c, F.lit("")))) / size)
            * F.log2(F.greatest((n - F.length(F.replace(text, c, F.lit("")))) / size, F.lit(1e-9)))
        ),
    )
    return {
        "length": n.cast("double"),
        "host_length": F.length(host).cast("double"),
        "host_labels": _count(host, "[^.]").cast("double"),
        "host_hyphens": _count(host, "[^-]").cast("double"),
        "host_digits": _count(host, "[^0-9]").cast("double"),
        "depth": _count(path, "[^/]").cast("double"),
        "digit_ratio": share("[^0-9]"),
        "letter_ratio": share("[^A-Za-z]"),
        "parameters": _count(F.regexp_extract(text, r"\?([^#]*)", 1), "[^=]").cast("double"),
        "fragment": F.contains(text, F.lit("#")).cast("double"),
        "secure": F.startswith(F.lower(text), F.lit("https")).cast("double"),
        "entropy": entropy,
    }


def filter_urls(
    df: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    sample: int = 8_000,
    trees: int = 12,
    depth: int = 4,
    default: str = "allow",
    seed: int = 7,
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (null without trees).

    Columns of ``df`` that have one of these names are left out.
    """
    kept = [c for c in df.columns if c.lower() not in ADDED]
    df = df.select(F.struct(*kept, F.lit(0).alias("__")).alias("__row"), F.col(url).cast("string").alias("url"))
    results = [*[F.col("__row")[c].alias(c) for c in kept], "host", "path", "rule"]
    url = "url"
    judged = judge_by_rules(df, url, rules)
    numbers = F.array(*lexical_features(F.col(url), F.col("host"), F.col("path")).values())
    suffix = F.substring_index("host", ".", -1)
    labelled = judged.filter("rule_action is not null").select(url, "host", "path", (F.col("rule_action") == "block").cast("double").alias("label"))
    drawn = sample_by_count(labelled, url, sample).limit(4 * sample)
    train = stage(drawn.select(suffix.alias("suffix"), numbers.alias("numbers"), "label", "weight"), "url-labels")
    kinds = train.agg(F.count_distinct("label"), F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()
    if kinds[0] < 2:
        return judged.select(*results, F.coalesce("rule_action", F.lit(default)).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    prior = float(kinds[1])
    # no more rows than the sample
    rates = F.broadcast(train.groupBy("suffix").agg(((F.sum(F.col("label") * F.col("weight")) + 20 * prior) / (F.sum("weight") + 20)).alias("rate")))

    def vectors(part: DataFrame) -> DataFrame:
        joined = part.join(rates, "suffix", "left")
        return joined.withColumn("__x", array_to_vector(F.concat("numbers", F.array(F.coalesce("rate", F.lit(prior))))))

    model = GBTClassifier(featuresCol="__x", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, maxBins=32, seed=seed).fit(
        vectors(train).select("__x", "label", "weight").coalesce(4)
    )
    fresh = judged.withColumn("suffix", suffix).withColumn("numbers", numbers)
    scored = model.transform(vectors(fresh))
    blocked = vector_to_array("probability")[1]
    method = F.when(blocked >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(*results, F.coalesce("rule_action", method).alias("verdict"), blocked.alias("block_score"))
