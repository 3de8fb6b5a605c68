"""URL filter: rules first, then logistic regression on hashed character n-grams.

A url is split into host and path. The longest rule that fits decides; every other url is
judged by a model of the character n-grams of its host and its path (each hashed apart),
fitted on a small table of labelled urls.

The features are built by Spark's string functions and the weights are applied in Arrow
batches, so the work is one narrow pass over the urls; a table's other columns are not read.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule
fits it and the model judges it by its intercept alone; repeated rows are judged alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from boardroll.llm.common import share, stage

_KEPT = 200_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def longest_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest fitting rule of ``rules`` (``host/path`` to verdict), or null.

    A rule fits its host and that host's subdomains where the path starts with the rule's.
    """
    found = F
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)
        found = found.when(fits, F.lit(rule))
    return found


def grams(host: str, path: str, low: int = 2, high: int = 4, bits: int = 16) -> list[int]:
    """Distinct hashed n-grams; host and path have their own, with marks at both ends."""
    found = set()
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in range(low, high + 1):
            for k in range(len(text) - n + 1):
                found.add(zlib.crc32(f"{kind}{text[k : k + n]}".encode("utf-8", "replace")) >> (32 - bits))
    return sorted(found)


@dataclass
class UrlModel:
    """Weights by hashed n-gram, and the intercept, of the log odds of ``block``."""

    bias: float
    weights: np.ndarray
    bits: int

    def score(self, host: str, path: str) -> float:
        margin = self.bias
        if host or path:
            margin += self.weights[grams(host, path, bits=self.bits)].sum()
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[tuple[str, str, str]], *, bits: int = 16, l2: float = 1e-4, steps: int = 300, rate: float = 0.05) -> UrlModel:
    """From (host, path, verdict) rows. Classes weigh alike; without both, the model is even."""
    rows = sorted(rows)
    y = np.array([verdict == "block" for *_, verdict in rows], float)
    weights = np.zeros(1 << bits)
    if not len(y) or y.min() == y.max():
        bias = 0.0 if not len(y) else (3.0 if y[0] else -3.0)
        return UrlModel(bias, weights, bits)
    x = [grams(host, path, bits=bits) for host, path, _ in rows]
    column = np.concatenate(x)
    row = np.repeat(np.arange(len(x)), [len(k) for k in x])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    bias, first, second = 0.0, np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        margin = np.bincount(row, weights[column], len(y)) + bias
        error = share * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        slope = np.bincount(column, error[row], len(weights)) + l2 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        bias -= rate * error.sum()
    return UrlModel(float(bias), weights, bits)


def rule_labels(pages: DataFrame, rules: Mapping[str, str], most: int = 2000) -> DataFrame:
    """A small labelled url table: at most ``most`` urls that rules decide, in hash order."""
    host, path = split_url(F.col("url"))
    rule = longest_rule(host, path, rules)
    verdict = _verdict(F.col("rule"), rules)
    named = pages.select(host.alias("host"), path.alias("path"), rule.alias("rule")).where("rule IS NOT NULL")
    order = F.xxhash64("host", "path")
    return named.select("host", "path", verdict.alias("verdict")).distinct().orderBy(order, "host", "path").limit(most)


def _verdict(rule: Column, rules: Mapping[str, str]) -> Column:
    found = F
    for name, verdict in rules.items():
        found = found.when(rule == name, F.lit(verdict))
    return found


def judge(pages: DataFrame, rules: Mapping[str, str], labelled: DataFrame, most: int = 5000) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's block_score of every page.

    ``labelled`` has host, path and verdict; the first ``most`` rows in hash order train.
    """
    drawn = labelled.where("verdict IN ('allow', 'block')").select("host", "path", "verdict")
    drawn = drawn.orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(most)
    model = fit([tuple(r) for r in stage(drawn, "url-labels").collect()])
    shared = share(pages, model)  # a fixed number of weights
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    split = split.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    kind = pages.schema["page_id"].dataType
    names = [StructField(n, StringType()) for n in ("host", "path", "rule")]
    schema = StructType([StructField("page_id", kind), *names, StructField("block_score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared(), {}
        for batch in batches:
            scores = []
            for pair in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if pair not in known:
                    if len(known) >= _KEPT:
                        known.clear()
                    known[pair] = own.score(*pair)
                scores.append(known[pair])
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    scored = split.mapInArrow(run, schema)
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce(_verdict(F.col("rule"), rules), learned).alias("verdict"), "block_score",
    )
