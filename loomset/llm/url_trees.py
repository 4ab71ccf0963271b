"""URL verdicts: rules by host and path first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that rules decide. Features are lengths, depth,
digits, character entropy, parameters, and statistics of the host's suffix over
the whole table. Everything is DataFrame code and Spark's own trees; scoring
runs inside the query's plan without any Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths with a beginning."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, found, 1), F.lit(""))
    return F.translate(host, _UPPER, _LOWER), F.coalesce(F.regexp_extract(url, found, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits, or null; of equally long ones the first named."""
    chosen = F.lit(None)
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.split(text, "")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("double")


#: Partitions of the bounded training table, however many the pages have.
FIT_PARTS = 8

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters",
    "has_query", "has_fragment", "suffix_pages", "suffix_hosts", "suffix_blocked",
)


def _features(url: Column) -> dict[str, Column]:
    length = F.length(url).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "url_length": length,
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/"),
        "labels": _count(F.col("host"), "."),
        "digit_ratio": _count(url, "0-9") / F.greatest(length, F.lit(1.0)),
        "hyphens": _count(url, "-_"),
        "entropy": _entropy(url),
        "parameters": F.when(query != "", _count(query, "&;") + 1).otherwise(0.0),
        "has_query": F.contains(url, F.lit("?")).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
    }


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    fit_rows: int = 20_000,
    trees: int = 12,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """A verdict for every row: ``key``, ``host``, ``path``, ``rule``, ``verdict``, ``block_score``.

    ``verdict`` is that of the longest fitting rule, else the trees' ("block"
    from a score of 0.5). A null URL has an empty host and path. The trees are
    fitted on at most ``fit_rows`` of the rows that rules decide, half of each
    verdict, those with the smallest hash of key and URL; weights restore the verdicts'
    shares. Suffix statistics cover all rows. If rules decide none, or all
    alike, every other URL gets that one verdict, or "allow".
    """
    host, path = url_parts(F.col(url))
    known = written(
        pages.select(F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
        .withColumn("chosen", rule_for(F.col("host"), F.col("path"), rules))
        .withColumn("label", F.when(F.col("chosen").isNotNull(), (F.col("chosen.verdict") == "block").cast("double")))
        .withColumn("suffix", F.substring_index("host", ".", -1)),
        "url-parts",
    )
    suffixes = written(
        known.groupBy("suffix", "host")
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("label").alias("blocked"), F.count("label").alias("labelled"))
        .groupBy("suffix")
        .agg(
            F.log1p(F.sum("pages")).alias("suffix_pages"),
            F.log1p(F.count(F.lit(1))).alias("suffix_hosts"),
            ((F.coalesce(F.sum("blocked"), F.lit(0.0)) + 1) / (F.sum("labelled") + 2)).alias("suffix_blocked"),
        ),
        "url-suffixes",
    )
    labelled, blocked = known.agg(F.count("label"), F.sum("label")).first()
    if not labelled or blocked in (0, labelled):
        score = known.withColumn("block_score", F.lit(1.0 if labelled and blocked else 0.0))
    else:
        featured = known.withColumns(_features(F.col("url"))).join(suffixes, "suffix")
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured)
        # Of each class as many rows, weighted so that both count as in the table.
        each = max(1, fit_rows // 2)
        classes = [
            rows.filter(F.col("label") == label)
            .select("features", "label", F.lit(held / min(held, each)).alias("weight"), F.xxhash64("key", "url").alias("hash"), "url")
            .orderBy("hash", "url")
            .limit(each)
            for label, held in ((0.0, labelled - blocked), (1.0, blocked))
        ]
        sample = written(classes[0].union(classes[1]).select("features", "label", "weight").repartition(FIT_PARTS), "url-sample")
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, weightCol="weight").fit(sample)
        score = model.transform(rows).withColumn("block_score", vector_to_array("probability")[1])
    by_trees = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return score.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", by_trees).alias("verdict"),
        "block_score",
    )
