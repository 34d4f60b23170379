"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Only DataFrame functions and Spark ML on the JVM; no Python runs on executors.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsight.llm.common import stored

# bound of the labelled URLs that the trees are fitted on, chosen by a hash of the URL
FIT_ROWS = 20_000
TREES, DEPTH = 12, 4
FEATURES = [
    "n_chars", "host_chars", "path_chars", "depth", "host_labels", "n_digits", "digit_ratio",
    "n_hyphens", "n_params", "entropy", "host_entropy", "has_fragment", "suffix_rate",
    "suffix_weight",
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    text: str  # host, then the start of the path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


class Model(NamedTuple):
    trees: GBTClassificationModel | None  # None: all labels were equal
    constant: float  # share of blocked URLs among the labelled ones
    suffixes: DataFrame  # suffix, suffix_rate, suffix_weight


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits for each character; 0 for an empty text."""
    size = F.char_length(text).cast("double")
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")

    def part(total: Column, c: Column) -> Column:
        share = (size - F.char_length(F.replace(text, c, F.lit("")))) / size
        return total - share * F.log2(share)

    return F.when(size > 0, F.aggregate(chars, F.lit(0.0), part)).otherwise(0.0)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def lexical(urls: DataFrame, url_col: str) -> DataFrame:
    """Adds the features that the URL alone gives; a null URL is an empty one."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_of(url), path_of(url)
    size = lambda c: F.char_length(c).cast("double")
    many = lambda c, what: size(F.regexp_replace(c, f"[^{what}]", ""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = many(url, "0-9")
    return urls.withColumns({
        "n_chars": size(url), "host_chars": size(host), "path_chars": size(path),
        "depth": many(path, "/"), "host_labels": many(host, ".") + 1.0, "n_digits": digits,
        "digit_ratio": digits / F.greatest(size(url), F.lit(1.0)),
        "n_hyphens": many(url, "\\-_"),
        "n_params": F.when(query == "", 0.0).otherwise(many(query, "&") + 1.0),
        "entropy": _entropy(url), "host_entropy": _entropy(host),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "suffix": suffix_of(host),
    })


def _assembled(rows: DataFrame, suffixes: DataFrame, constant: float) -> DataFrame:
    joined = rows.join(suffixes, "suffix", "left").fillna(
        {"suffix_rate": constant, "suffix_weight": 0.0}
    )
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on ``labelled(url, block)``; ``block`` is 1 or 0 (runs jobs).

    Rows with a null URL or label are not used; equal URLs count once. Suffix statistics
    cover all labelled URLs; the trees see at most ``fit_rows`` of them. With labels of one
    class, or none, the model is that constant.
    """
    known = (
        labelled.filter(F.col("url").isNotNull() & F.col("block").isNotNull())
        .groupBy("url").agg(F.max(F.col("block").cast("double")).alias("block"))
    )
    suffixes = stored(
        known.groupBy(suffix_of(host_of(F.col("url"))).alias("suffix")).agg(
            ((F.sum("block") + 1) / (F.count("*") + 2)).alias("suffix_rate"),
            F.log1p(F.count("*").cast("double")).alias("suffix_weight"),
        ),
        "suffixes",
    )
    chosen = stored(known.orderBy(F.xxhash64("url"), "url").limit(fit_rows), "url-fit")
    seen = chosen.agg(F.count("*"), F.coalesce(F.avg("block"), F.lit(0.0))).first()
    constant = float(seen[1])
    if not seen[0] or constant in (0.0, 1.0):
        return Model(None, constant, suffixes)
    rows = _assembled(lexical(chosen, "url"), suffixes, constant).select("features", "block")
    trees = GBTClassifier(
        labelCol="block", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=7,
        subsamplingRate=1.0,
    ).fit(rows.coalesce(4))
    return Model(trees, constant, suffixes)


def judge(urls: DataFrame, rules: list[Rule], model: Model, url_col: str = "url") -> DataFrame:
    """Adds ``host, path, rule, verdict, block_score``; those columns are replaced if present.

    The verdict is the rule's, else ``block`` from a predicted probability of 0.5 on. Null
    and empty URLs have an empty host and path and are judged by the trees like any other.
    ``block_score`` is null where a rule decides. Other columns and repeated rows stay.
    """
    kept = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "block_score")]
    own = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(url_col).alias("_url")
    )
    rows = lexical(own, "_url").withColumns({
        "_host": host_of(F.col("_url")), "_path": path_of(F.col("_url")),
    })
    rows = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    if model.trees is None:
        scored = rows.withColumn("_p", F.lit(model.constant))
    else:
        scored = model.trees.transform(
            _assembled(rows, model.suffixes, model.constant)
        ).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(
        *[F.col("_row")[c].alias(c) for c in kept],
        F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce(
            F.col("_rule.verdict"), F.when(F.col("_p") >= 0.5, "block").otherwise("allow")
        ).alias("verdict"),
        F.when(F.col("_rule").isNull(), F.col("_p")).alias("block_score"),
    )
