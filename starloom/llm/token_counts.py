"""Operator 9: an exact length histogram that answers every context limit.

Documents are encoded, aggregated by encoded length, and suffix sums over the
histogram give, for each length ``n`` that occurs, the documents and tokens at
or above it and the total if every document were cut at ``n`` tokens.  Totals,
quantiles and truncated totals for any limit follow from one row of it.

Defined cases: null and empty texts have length 0; repeated rows count each
time; ids are not read; an empty table gives an empty histogram; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import prepare, text_column, written

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the vocabulary file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters that \s of the pattern stands for.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
BLOCK = 1024
LONG_SPACE = 10_000
_ENCODERS: dict = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count_tokens(encoder, text: str) -> int:
    """The encoded length of ``text``.

    The pattern's search for the end of a white-space run goes back character by
    character, which overflows the tokenizer's stack on very long runs.  Those are
    cut out: the pattern makes one piece of such a run (without its last character
    if a word follows, which that character joins), so the parts' counts add up.
    """
    total = at = 0
    for run in re.finditer(f"[{SPACE}]{{{LONG_SPACE},}}", text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoder.encode_ordinary(text[at:run.start()])) + len(encoder._encode_single_piece(text[run.start():stop]))
        at = stop
    return total + len(encoder.encode_ordinary(text[at:]))


def token_lengths(docs: DataFrame, text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The encoded length of every text, in a column ``n_tokens``."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for b in batches:
            lengths = [count_tokens(encoder, t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, type=pa.int64())], names=["n_tokens"])

    return docs.select(text_column(text_col).alias("_t")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``: partial sums per task, then one row per length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length: documents and tokens at or above it, truncated total, share of shorter or equal documents.

    Sums run in two levels, inside blocks of ``BLOCK`` lengths and over the
    blocks, so no single task sees the whole histogram.
    """
    h = histogram.withColumn("_b", F.floor(F.col("n_tokens") / BLOCK)).withColumn("_w", F.col("n_tokens") * F.col("n_docs"))
    per_block = h.groupBy("_b").agg(F.sum("n_docs").alias("_bd"), F.sum("_w").alias("_bw"))
    later = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = per_block.select("_b", F.coalesce(F.sum("_bd").over(later), F.lit(0)).alias("_ld"),
                              F.coalesce(F.sum("_bw").over(later), F.lit(0)).alias("_lw"))
    total = per_block.agg(F.coalesce(F.sum("_bd"), F.lit(0)).alias("docs"), F.coalesce(F.sum("_bw"), F.lit(0)).alias("tokens")).first()
    inside = Window.partitionBy("_b").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    s = h.join(blocks, "_b").select(
        "n_tokens", "n_docs", (F.sum("n_docs").over(inside) + F.col("_ld")).alias("docs_from"),
        (F.sum("_w").over(inside) + F.col("_lw")).alias("tokens_from"))
    s = s.withColumn("total_docs", F.lit(total.docs).cast("long")).withColumn("total_tokens", F.lit(total.tokens).cast("long"))
    up_to = F.col("total_docs") - F.col("docs_from") + F.col("n_docs")
    return s.select("n_tokens", "n_docs", "docs_from", "tokens_from",
                    up_to.alias("docs_up_to"), (up_to / F.col("total_docs")).alias("quantile"),
                    (F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from"))
                    .alias("truncated_total"), "total_docs", "total_tokens")


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut at ``limit``."""
    row = sums.where(F.col("n_tokens") >= limit).orderBy("n_tokens").limit(1).collect()
    if row:
        r = row[0]
        return r.total_tokens - r.tokens_from + limit * r.docs_from
    row = sums.limit(1).collect()
    return row[0].total_tokens if row else 0


def quantile(sums: DataFrame, q: float) -> int | None:
    """The smallest length that at least a share ``q`` of the documents does not exceed."""
    row = sums.where(F.col("docs_up_to") >= F.lit(q) * F.col("total_docs")).orderBy("n_tokens").limit(1).collect()
    return row[0].n_tokens if row else None


def token_counts(docs: DataFrame, text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """The suffix-summed histogram of ``docs``."""
    lengths = token_lengths(docs, text_col, vocabulary)
    return suffix_sums(written(length_histogram(lengths), "token-histogram"))
