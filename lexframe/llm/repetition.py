"""Repetition inside single documents, and verdicts on the hosts they come from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .textvec import chunks, mix, ngrams, text_lengths, words

#: Words of a passage, share of repeated words from which a document fails, words below which none is judged.
PASSAGE, SHARE_TENTHS, LEAST_WORDS = 8, 3, 40
#: Bounds of the correlation of documents of one host: the prior counts as many documents as its inverse, less one.
LEAST_ALIKE, MOST_ALIKE = 1e-6, 0.5


def repeated_words(texts: list[str], passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(words, repeated words) of each text.

    A word is repeated when it lies in a passage of `passage` consecutive words that also starts at
    an earlier word of the same text.
    """
    codes, docs, _ = words(texts)
    total = np.bincount(docs, minlength=len(texts))
    grams, owner = ngrams(codes, docs, passage)
    at = np.flatnonzero(owner >= 0)
    own = mix(grams[at] ^ mix(owner[at].astype(np.uint64)))
    _, first, same = np.unique(own, return_index=True, return_inverse=True)
    again = at[first[same] < np.arange(len(at))]
    steps = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(steps, again, 1)
    np.add.at(steps, again + passage, -1)
    return total, np.bincount(docs[np.cumsum(steps)[:-1] > 0], minlength=len(texts))


def measure_repetition(df: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """(key, n_words, n_repeated) of every row; zeros for null, empty and blank texts. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = text_lengths(batch.column(1))
            for a, b in chunks(lengths):
                part = batch.slice(a, b - a)
                total, again = repeated_words([t or "" for t in part.column(1).to_pylist()], passage)
                rest = [part.column(i) for i in range(2, part.num_columns)]
                yield pa.RecordBatch.from_arrays([part.column(0), *rest, pa.array(total, pa.int64()), pa.array(again, pa.int64())], names)

    rest = [c for c in df.columns if c not in (key, text)]
    names = [key, *rest, "n_words", "n_repeated"]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [key, *rest])
    return df.select(*(df[f"`{c}`"] for c in [key, text, *rest])).mapInArrow(run, f"{schema}, n_words bigint, n_repeated bigint")


def host_verdicts(measures: DataFrame, host: str = "source", limit: float = 0.1) -> DataFrame:
    """(host, n_docs, n_failed, rate, bad) from documents with a column `failed`, one row for each host and one for none.

    The failure rates of hosts are shrunk by a beta prior fitted to them by moments: its mean is the rate of
    all documents, and its weight is that at which the hosts' rates, weighted by their documents, vary
    as much as they do beyond what chance adds for hosts of their sizes, but one document at least. A host
    with few documents stays near the mean. `bad` is a shrunk rate above `limit`. Documents without a host count for none: their
    row has neither rate nor verdict. Sums are combined before the shuffle, so a host with a third of
    the documents is one row per task.
    """
    sums = measures.groupBy(host).agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("bigint")).alias("n_failed"))
    hosts = sums.where(F.col(host).isNotNull())
    n, failed = F.col("n_docs"), F.col("n_failed")
    total = hosts.agg(F.sum("n_docs").alias("docs"), F.sum("n_failed").alias("bad"), F.sum(n * n).alias("squares"), F.count("*").alias("hosts"), F.sum(failed * failed / n).alias("spread"))
    mean = F.col("bad") / F.col("docs")
    noise = mean * (1 - mean)
    between = 1 - F.col("squares") / (F.col("docs") * F.col("docs"))  # sum of w (1 - w), w being a host's share of the documents
    within = (F.col("hosts") - 1) / F.col("docs")  # sum of w (1 - w) / n
    seen = F.col("spread") / F.col("docs") - mean * mean  # sum of w (rate - mean)^2
    alike = F.least(F.greatest(F.coalesce((seen - noise * within) / F.when(noise * (between - within) > 0, noise * (between - within)), F.lit(LEAST_ALIKE)), F.lit(LEAST_ALIKE)), F.lit(MOST_ALIKE))
    prior = total.select(mean.alias("mean"), (1 / alike - 1).alias("weight"))
    mean, weight = (prior.select(c).scalar() for c in ("mean", "weight"))
    rate = F.when(F.col(host).isNotNull(), (failed + mean * weight) / (n + weight))
    return sums.select(host, "n_docs", "n_failed", rate.alias("rate"), (rate > limit).alias("bad"))


def repetition(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: float = 0.1) -> DataFrame:
    """(key, host, n_words, n_repeated, share, failed, host_rate, host_bad) of every row of `df`.

    `failed` is the rule on the document alone: `LEAST_WORDS` words or more of which
    `SHARE_TENTHS` tenths or more are repeated. The host's shrunk failure rate and verdict are
    joined to its documents; they are null where the host is. `share` is 0 for texts without words.
    """
    rows = checkpointed(measure_repetition(df.select(df[f"`{key}`"], df[f"`{text}`"], df[f"`{host}`"]), key, text))
    failed = (F.col("n_words") >= LEAST_WORDS) & (F.col("n_repeated") * 10 >= F.col("n_words") * SHARE_TENTHS)
    rows = rows.withColumn("share", F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(0.0)).withColumn("failed", failed)
    verdicts = host_verdicts(rows, host, limit).select(F.col(host).alias("_host"), F.col("rate").alias("host_rate"), F.col("bad").alias("host_bad"))
    return rows.join(verdicts, F.col(host).eqNullSafe(F.col("_host"))).select(key, host, "n_words", "n_repeated", "share", "failed", "host_rate", "host_bad")
