"""Quality rules as a short-circuit cascade.

Every rule rejects or passes a document; a document is kept when no rule rejects
it. Rules run in the order of rejections per second of work, both estimated on a
bounded sample, and a document's evaluation ends at its first rejection. Because
all rules must pass, the order changes the cost and never the verdict.

Edge cases: a null text has no words and is rejected as too short; repeated rows
get the same verdict, each on its own; an empty table gives an empty result; long
texts are read whole. Extra columns are never read.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import repeat
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Frame, arrow_batches, pick

SYMBOLS = b"#*$%&|<>"
#: expected number of texts in the sample for the cost and selectivity estimate
SAMPLE_ROWS = 1000


class Doc:
    """Features of one UTF-8 text, each computed when a rule first asks for it."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()          # bytes.split(): space and \t\n\v\f\r

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, (bytes([c]) for c in SYMBOLS)))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        grams = list(zip(w, w[1:], w[2:]))
        if len(set(grams)) == len(grams):
            return 0
        counts = Counter(grams)
        covered, end = 0, 0               # end: words before it are counted
        for i, g in enumerate(grams):
            if counts[g] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Doc], bool]


BASE_RULES = (
    Rule("too_short", lambda d: d.n_words < 50),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words),
)
DEFAULT_RULES = BASE_RULES + (
    Rule("symbols", lambda d: 100 * d.n_symbols > 10 * d.n_words),
    Rule("repeated_lines", lambda d: 100 * d.n_dup_lines > 30 * len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 25 * d.n_words),
)


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES,
               sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules, the one with the most rejections per second of work first."""
    texts = pick(docs, "text")
    n = texts.count()
    if not n:
        return list(rules)
    arrow_batches(docs.sparkSession)
    sample = texts.sample(min(1.0, sample_rows / n), seed=7)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _texts(batch, "text")
            rows = []
            for rule in rules:
                began = time.perf_counter()
                n_rejected = sum(rule.rejects(Doc(t)) for t in values)
                rows.append((rule.name, n_rejected, time.perf_counter() - began))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("rule", "rejected", "seconds"), r)) for r in rows])

    seen = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in
            sample.mapInArrow(measure, "rule string, rejected long, seconds double")
                  .groupBy("rule").agg(F.sum("rejected").alias("rejected"),
                                       F.sum("seconds").alias("seconds")).collect()}
    return sorted(rules, key=lambda r: -seen.get(r.name, 0.0))


def _kept(doc: Doc, order: list[Rule]) -> bool:
    return not any(rule.rejects(doc) for rule in order)


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that every rule passes, with all their columns."""
    order = rule_order(docs, rules, sample_rows)
    arrow_batches(docs.sparkSession)
    f = Frame(docs)
    text = f"_in{f.names.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([_kept(Doc(t), order) for t in _texts(batch, text)],
                                        pa.bool_()))

    return f.restore(f.df.mapInArrow(run, f.df.schema))


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES,
                   base_rules: tuple[Rule, ...] = BASE_RULES,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: its features, ``base_failed`` (a base rule rejects it)
    and ``kept`` (the cascade's verdict; the cascade includes the base rules)."""
    order = rule_order(docs, rules, sample_rows)
    arrow_batches(docs.sparkSession)
    slim = pick(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [Doc(t) for t in _texts(batch, "text")]
            kept = list(map(_kept, made, repeat(order)))
            failed = [any(r.rejects(d) for r in base_rules) for d in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([getattr(d, x) for d in made], pa.int64())
                                    for x in FEATURES),
                 pa.array(failed, pa.bool_()),
                 pa.array([k and not x for k, x in zip(kept, failed)], pa.bool_())],
                names=["doc_id", *FEATURES, "base_failed", "kept"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{x} long" for x in FEATURES)
                           + ", base_failed boolean, kept boolean")
