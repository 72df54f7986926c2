"""Token counts: an exact length histogram.

Documents are encoded whole with a public tokenizer and aggregated by encoded
length; suffix sums over the histogram answer totals, quantiles and truncated
totals for every context limit. The histogram has a row for each length that
occurs; its suffix sums are taken within blocks of lengths and over the
blocks' totals, so that no task holds the whole histogram.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public pattern that goes with the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH_BLOCK = 128
#: Runs of white space from this many characters on are encoded by themselves: the pattern would
#: track back over them until its stack ends.
LONG_RUN = 10_000
_LONG_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], int]:
    """Number of tokens of a text under a byte-level BPE given as ranks."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(text: str) -> int:
        # The pattern takes a run of white space at the end of the text as one piece, and before another
        # character all of it but its last one; the text is cut just there.
        total, at = 0, 0
        for run in _LONG_RUN.finditer(text):
            cut = run.end() if run.end() == len(text) else run.end() - 1
            total += len(encoding.encode_ordinary(text[at:run.start()])) + len(encoding._encode_single_piece(text[run.start():cut]))
            at = cut
        return total + len(encoding.encode_ordinary(text[at:]))
    return lambda text: count(text) if text else 0


_ENCODERS: dict[str, Callable[[str], int]] = {}


def token_counts(docs: DataFrame, text_col: str = "text", out_col: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` without the text, with ``out_col`` (replaced if there): tokens of the whole text, 0 for null or empty.
    The vocabulary is a file at the same path on every executor."""
    rest = [c for c in docs.columns if c not in (text_col, out_col)]
    src = docs.select(*rest, text_col)

    def run(batches):
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = encoder(vocabulary)
        count = _ENCODERS[vocabulary]
        for batch in batches:
            *own, texts = batch.columns
            yield pa.RecordBatch.from_arrays([*own, pa.array([count(t) for t in texts.to_pylist()], pa.int64())], names=[*rest, out_col])
    return src.mapInArrow(run, StructType([*src.schema.fields[:-1], StructField(out_col, LongType())]))


def length_histogram(counts: DataFrame, by: list[str] | None = None, length_col: str = "n_tokens", block: int = LENGTH_BLOCK) -> DataFrame:
    """For each length that occurs (in each group of ``by``): n_docs, and with
    the suffix sums docs_at_least, tokens_at_least, total_docs, total_tokens,
    truncated_tokens (what is left when every document is cut to this length),
    cut_docs (longer documents) and quantile (share of documents at most this long).
    Null group values are a group; null lengths count as 0; no rows, no rows."""
    by = by or []
    src = counts.select(*by, F.coalesce(F.col(length_col), F.lit(0)).alias("n_tokens"))
    hist = src.groupBy(*by, "n_tokens").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / block))
    totals = hist.groupBy(*by, "block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    group = [F.col(c) for c in by] or [F.lit(0)]
    above = Window.partitionBy(*group).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = totals.select(*by, "block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
                           F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"))
    on = hist["block"] == totals["block"]
    for c in by:
        on = on & hist[c].eqNullSafe(totals[c])
    within = Window.partitionBy(*[hist[c] for c in by], hist["block"]).orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    joined = hist.join(totals, on).select(*[hist[c] for c in by], "n_tokens", "n_docs", "total_docs", "total_tokens",
                                          (F.col("d_above") + F.sum("n_docs").over(within)).alias("docs_at_least"),
                                          (F.col("t_above") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(within)).alias("tokens_at_least"))
    cut = F.col("docs_at_least") - F.col("n_docs")
    return joined.select(*by, "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens", cut.alias("cut_docs"),
                         (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
                         ((F.col("total_docs") - cut) / F.col("total_docs")).alias("quantile"))


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens that remain when every document is cut to ``limit``, for any limit, from the suffix sums alone."""
    row = histogram.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").limit(1).first()
    if row is None:
        row = histogram.limit(1).first()
        return row["total_tokens"] if row else 0
    return row["total_tokens"] - row["tokens_at_least"] + limit * row["docs_at_least"]
