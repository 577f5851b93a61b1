"""Operator 1: URL filter by rules and logistic regression on hashed character n-grams.

A URL's host and path are judged by the longest rule that fits; where none
does, a logistic regression decides, over character n-grams of the host and
the path hashed to a fixed number of weights.  It is trained on a small
labelled URL table, of which at most ``SAMPLE`` distinct URLs of each label
are read, those first in the order of their hash.  The weights (128 KB) go
to the workers; scoring is whole-array arithmetic over Arrow batches.

Defined cases: a null URL or one without ``://`` has empty host and path and
is judged by the regression on nothing but the bias; without labelled rows of
both kinds the verdict is the only kind there is, or allow; repeated rows are
judged alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import U64, mix64, prepare

SAMPLE = 5_000
SIZES = (2, 3, 4, 5)
WEIGHTS = 1 << 14
ROUNDS, RATE, RIDGE = 120, 0.5, 1e-4
BASE = U64(0x9E3779B97F4A7C15)

# Rules: (host/path prefix, verdict).
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def ngram_features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of all URLs at once: URL number, weight index, value (1 / sqrt of the URL's n-grams)."""
    who, index = [], []
    for salt, texts in ((1, hosts), (2, paths)):
        raw = [b"^" + t.encode() + b"$" for t in texts if t]
        owner = np.array([k for k, t in enumerate(texts) if t], dtype=np.int64)
        if not raw:
            continue
        data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(U64)
        sizes = np.array([len(r) for r in raw])
        ends = np.repeat(np.cumsum(sizes), sizes)
        own = np.repeat(owner, sizes)
        h = np.zeros(len(data), dtype=U64)
        place = np.arange(len(data))
        for n in range(1, max(SIZES) + 1):
            m = len(data) - n + 1
            if m <= 0:
                break
            h = h[:m] * BASE + data[n - 1:n - 1 + m] + U64(1)
            if n in SIZES:
                fits = place[:m] + n <= ends[:m]
                index.append((mix64(h[fits] + U64(salt * 31 + n)) % U64(WEIGHTS)).astype(np.int64))
                who.append(own[:m][fits])
    if not who:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    who, index = np.concatenate(who), np.concatenate(index)
    return who, index, 1 / np.sqrt(np.bincount(who, minlength=len(hosts)))[who]


def train(hosts: list[str], paths: list[str], block: list[int]) -> np.ndarray:
    """Weights and, last, the bias: full-gradient Adagrad, the same for the same rows in the same order."""
    y = np.asarray(block, dtype=float)
    w = np.zeros(WEIGHTS + 1)
    if len(y) == 0 or y.min() == y.max():
        w[-1] = 10.0 if len(y) and y[0] else -10.0
        return w
    who, index, value = ngram_features(hosts, paths)
    each = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both kinds weigh the same
    past = np.full(WEIGHTS + 1, 1e-8)
    for _ in range(ROUNDS):
        z = np.bincount(who, weights=w[index] * value, minlength=len(y)) + w[-1]
        error = (1 / (1 + np.exp(-z)) - y) * each
        grad = np.append(np.bincount(index, weights=error[who] * value, minlength=WEIGHTS) + RIDGE * w[:-1], error.sum())
        past += grad * grad
        w -= RATE * grad / np.sqrt(past)
    return w


def block_probability(hosts: list[str], paths: list[str], weights: np.ndarray) -> np.ndarray:
    who, index, value = ngram_features(hosts, paths)
    z = np.bincount(who, weights=weights[index] * value, minlength=len(hosts)) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def judged_by_rules(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``host, path, verdict`` of the URLs that a rule decides: a labelled URL table."""
    rows = pages.select(host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    return rows.withColumn("verdict", rule_of(F.col("host"), F.col("path"), rules)[1]).where("verdict IS NOT NULL")


def train_on(labelled: DataFrame) -> np.ndarray:
    """Train on a bounded sample of a table ``host, path, verdict`` (allow or block)."""
    some = labelled.distinct().withColumn("_h", F.xxhash64("host", "path"))
    rows = []
    for kind in ("allow", "block"):
        rows += some.where(F.col("verdict") == kind).orderBy("_h", "host", "path").limit(SAMPLE).collect()
    return train([r.host for r in rows], [r.path for r in rows], [int(r.verdict == "block") for r in rows])


def url_verdicts(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict, block_probability per row."""
    prepare(pages.sparkSession)
    weights = train_on(labelled)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = block_probability(b.column("host").to_pylist(), b.column("path").to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, type=pa.float64())], names=[*b.schema.names, "p"])

    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    scored = rows.mapInArrow(judge, T.StructType([*rows.schema.fields, T.StructField("p", T.DoubleType())]))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
                         F.coalesce(says, F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         F.col("p").alias("block_probability"))
