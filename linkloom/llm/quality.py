"""Quality rules per document and per host.

Counting is a map over rows. Failures are summed per host before anything is
shuffled; a host's rate is shrunk towards all hosts by a beta prior fitted to
their rates, and its verdict is joined back as a small written table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.scratch import materialize

_SPACE = " \t\n\v\f\r"
_SYMBOLS = re.compile(r"[#*$%&|<>]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def count_text(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, and words inside 3-word windows that occur again."""
    words = text.encode().split()
    n = len(words)
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            if line in seen:
                lines += 1
            seen.add(line)
    windows: dict[tuple[bytes, bytes, bytes], int] = {}
    again: list[int] = []
    for at, window in enumerate(zip(words, words[1:], words[2:])):
        first = windows.setdefault(window, at)
        if first != at:
            again.append(first)
            again.append(at)
    repeated = len({at + k for at in again for k in range(3)})
    chars = len(text) - sum(map(text.count, _SPACE))
    return n, chars, len(_SYMBOLS.findall(text)), lines, repeated


@dataclass(frozen=True)
class Rules:
    """Limits of a document and of a host.

    A document fails with fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` of its words in repeated windows; these failures
    reject it. Symbols and repeated lines alone don't.

    A host's failures of a rule, with the fitted beta prior, give a posterior of
    its rate. The host is rejected if that exceeds, with a certainty of
    ``host_certainty`` standard deviations, the rate that ``host_quantile`` of them
    above the prior's mean marks: a rate that hosts hardly have. It is suspect if
    it exceeds the prior's mean so; then its documents that fail this rule are
    rejected too. Both deviations are those of normal distributions with the
    moments of the betas.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    host_quantile: float = 2.326
    host_certainty: float = 1.645

    def failures(self) -> dict[str, Column]:
        return {
            "short": F.col("n_words") < self.min_words,
            "repetitive": 100 * F.col("n_repeat_words") > self.max_repeat_percent * F.col("n_words"),
            "symbols": 100 * F.col("n_symbols") > self.max_symbol_percent * F.col("word_chars"),
            "dup_lines": 100 * F.col("n_dup_lines") > self.max_dup_line_percent * F.col("n_lines"),
        }


def count_words(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus the counts of ``text``; null text has no words."""
    added = [T.StructField(c, T.LongType()) for c in [*COUNTS, "n_lines"]]
    schema = T.StructType([docs.schema[c] for c in keep] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            rows = []
            for text in batch.column(at):
                text = text.as_py() or ""
                rows.append((*count_text(text), text.count("\n") + 1))
            counts = list(zip(*rows)) if rows else [()] * len(added)
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(c, pa.int64()) for c in counts],
                names=schema.names,
            )

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def host_rates(counted: DataFrame, host: str, rules: Rules) -> DataFrame:
    """Per host and rule: documents, failures, shrunk rate, whether the host is suspect; and its ``host_kept``.

    The prior is fitted by moments to the hosts' rates, each weighted by its
    documents: their mean, and their variance beyond what chance explains. Where
    hosts don't differ beyond that, the prior is as heavy as all documents, every
    host gets the common rate, and none is rejected. Null is a host like any other.
    """
    names = list(rules.failures())
    failed = counted.select(F.col(host).alias("host"), *[c.cast("long").alias(k) for k, c in rules.failures().items()])
    hosts = materialize(
        failed.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in names]), "hosts"
    )
    total = hosts.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("hosts"),
        *[F.sum(k).alias(k) for k in names],
        *[F.sum(F.col(k) * F.col(k) / F.col("n")).alias(f"{k}_squares") for k in names],
    ).first()
    out, kept = hosts, F.lit(True)
    for k in names:
        n = total["n"] or 1
        mean = (total[k] or 0) / n
        spread = (total[f"{k}_squares"] or 0.0) / n - mean * mean
        between = spread - mean * (1 - mean) * total["hosts"] / n
        weight = mean * (1 - mean) / between - 1 if between > 0 else float(n)
        weight = min(max(weight, 1.0), float(n))
        limit = mean + rules.host_quantile * math.sqrt(mean * (1 - mean) / (weight + 1))
        rate = (F.col(k) + mean * weight) / (F.col("n") + weight)
        sure = rate - rules.host_certainty * F.sqrt(rate * (1 - rate) / (F.col("n") + weight + 1))
        out = out.withColumn(f"{k}_rate", rate).withColumn(f"{k}_suspect", sure > mean)
        kept = kept & (sure <= limit)
    return out.withColumn("host_kept", kept)


def _verdicts(counted: DataFrame, host: str, rules: Rules) -> DataFrame:
    """The hosts that are rejected or suspect, a written table ``(_host, _bad, _<rule>)``."""
    names = list(rules.failures())
    rates = host_rates(counted, host, rules)
    told = rates.select(
        F.col("host").alias("_host"), (~F.col("host_kept")).alias("_bad"), *[F.col(f"{k}_suspect").alias(f"_{k}") for k in names]
    )
    return materialize(told.where(F.greatest("_bad", *[f"_{k}" for k in names])), "verdicts")


def _rejected(rules: Rules) -> Column:
    """Whether a document joined with its host's verdict goes."""
    fails = rules.failures()
    own = fails["short"] | fails["repetitive"]
    tainted = [F.coalesce(F.col(f"_{k}"), F.lit(False)) & failed for k, failed in fails.items()]
    return own | F.coalesce(F.col("_bad"), F.lit(False)) | reduce(or_, tainted)


def judge(counted: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to ``counted`` rows, which must be cheap to read twice.

    A document is kept if it passes its own rules and its host's verdict.
    """
    verdict, names = _verdicts(counted, host, rules), counted.columns
    fails = rules.failures()
    return (
        counted.join(verdict, F.col(host).eqNullSafe(F.col("_host")), "left")
        .withColumn("base_failed", fails["short"] | fails["repetitive"])
        .withColumn("kept", ~_rejected(rules))
        .select(*names, "base_failed", "kept")
    )


def assess(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per document: ``doc_id``, counts, ``base_failed``, ``kept``.

    Empty and null texts have no words and fail. Repeated rows stay; an empty
    table gives an empty result; columns besides these are not read.
    """
    counted = materialize(count_words(docs.select("doc_id", F.col(host).alias("_h"), "text"), ["doc_id", "_h"]), "counted")
    return judge(counted, "_h", rules).drop("_h", "n_lines")


def keep_good(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """``docs`` without the rejected rows, all columns kept.

    Texts are counted twice (for the hosts, then for the rows) and never shuffled.
    """
    names = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    renamed = dict(zip(names, plain.columns))
    plain = plain.select("*", F.col(renamed["text"]).alias("text"))
    counted = count_words(plain, list(renamed.values()))
    verdict = _verdicts(count_words(plain, [renamed[host]]), renamed[host], rules)
    joined = counted.join(verdict, F.col(renamed[host]).eqNullSafe(F.col("_host")), "left")
    return joined.where(~_rejected(rules)).select([F.col(renamed[c]).alias(c) for c in names])
