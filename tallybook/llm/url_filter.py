"""URL filter: listed rules, and a character language-model ratio for the rest.

The most specific rule that fits a url's host (or a parent domain) and the beginning of its path decides. What the rules
accept and reject are the examples for two character models, one for each side, of host and path. The models are
smoothed and of variable order: a character's probability mixes all contexts of up to ``ORDER`` characters, each
weighing as much as it has been seen, down to a uniform guess. A url's score is the difference of the two
log-likelihoods a character. Four fifths of the examples (by a hash of host and path) feed the counts; the others are scored
to calibrate the limit at which the two sides are told apart best (balanced accuracy, over all these urls).

Every example of the corpus is counted. Counts sit in hash tables whose size follows the number of examples, up to
``MOST_BUCKETS`` (so what is broadcast is bounded); tasks hand on one table each.

Defined cases: a url that is null or has no ``://`` has empty host and path, fits no rule, and is allowed, as is every
url while the rules give no example of one of the sides; repeated rows come back repeated; further columns are ignored;
a rule ``host/`` asks for a path that begins with ``/``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.tables import merged, stored
from tallybook.llm.tokens import joined, mix, pieces

#: Fixed values of the query: rule and verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
ORDER = 5
LEAST_BUCKETS, MOST_BUCKETS = 1 << 14, 1 << 21
#: Weight of the shorter context's guess, counted in characters seen.
SMOOTHING = 2.0
_BINS = 1000


def parsed(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = [F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2)]
    return F.translate(part[0], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part[1]


def with_rules(pages: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """page_id, host, path, rule, decided for each row."""
    host, path = parsed(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))

    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((F.col("host") == name) | F.endswith("host", F.lit(f".{name}"))) & F.startswith("path", F.lit(slash + rest))

    order = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    pick = F.coalesce(*[F.when(fits(r), F.lit(r)) for r, _ in order]) if order else F.lit(None).cast("string")
    verdict = reduce(lambda out, r: out.when(F.col("rule") == r[0], F.lit(r[1])), order, F.when(F.lit(False), F.lit("")))
    return rows.withColumn("rule", pick).withColumn("decided", verdict)


class Counts:
    """Of characters after contexts of 0 to ORDER characters, for both sides; the tables are hashed."""

    def __init__(self, buckets: int, table: np.ndarray | None = None) -> None:
        self.buckets = buckets
        # side, order, (character after context, context), bucket
        self.table = np.zeros((2, ORDER + 1, 2, buckets), dtype=np.int32) if table is None else table

    def slots(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """For each character of all texts (a zero byte ends each): its text, and by order its two buckets."""
        data, offsets = joined(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        at = np.arange(len(data)) - offsets[doc]
        code = data.astype(np.uint64) + np.uint64(1)
        context, out = np.full(len(data), 99, dtype=np.uint64), []
        for k in range(ORDER + 1):
            if k:
                back = np.zeros(len(data), dtype=np.uint64)
                back[k:] = code[:-k] if k < len(code) else 0
                context = mix(context * np.uint64(257) + np.where(at >= k, back, np.uint64(0)))
            mask = np.uint64(self.buckets - 1)
            out.append(((mix(context + code * np.uint64(0x9E3779B97F4A7C15)) & mask).astype(np.int64), (context & mask).astype(np.int64)))
        return doc, out

    def add(self, side: int, texts: pa.Array) -> None:
        for k, (both, context) in enumerate(self.slots(texts)[1]):
            self.table[side, k, 0] += np.bincount(both, minlength=self.buckets).astype(np.int32)
            self.table[side, k, 1] += np.bincount(context, minlength=self.buckets).astype(np.int32)

    def ratio(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood as accepted less that as rejected, per character."""
        doc, slots = self.slots(texts)
        total = np.zeros(len(doc))
        for side, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(doc), 1 / 256)
            for k, (both, context) in enumerate(slots):
                p = (self.table[side, k, 0][both] + SMOOTHING * p) / (self.table[side, k, 1][context] + SMOOTHING)
            total += sign * np.log(np.minimum(p, 1.0))
        n = np.bincount(doc, minlength=len(texts))
        return np.bincount(doc, total, len(texts)) / np.maximum(n, 1)


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, ratio for each row of ``pages``."""
    rows = stored(with_rules(pages, rules), "urls")
    fold = F.pmod(F.xxhash64("host", "path"), F.lit(5))
    examples = rows.where("decided IS NOT NULL").select(F.concat("host", "path").alias("text"), (F.col("decided") == "allow").cast("int").alias("side"), fold.alias("fold"))
    sizes = {r["side"]: r["count"] for r in examples.groupBy("side").count().collect()}
    if len(sizes) < 2:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("decided", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("ratio"))
    buckets = min(max(1 << (4 * sum(sizes.values()) - 1).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_rows = Counts(buckets), False
        for batch in pieces(batches):
            side = batch.column(1).to_numpy()
            for s in (0, 1):
                counts.add(s, batch.column(0).filter(pa.array(side == s)))
            any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([counts.table.tobytes()], pa.binary())], ["counters"])

    parts = examples.where("fold <> 0").select("text", "side").mapInArrow(counted, "counters binary")
    table = merged(parts, np.int32, np.add)
    table = np.zeros(2 * (ORDER + 1) * 2 * buckets, np.int32) if table is None else table
    model = pages.sparkSession.sparkContext.broadcast(table)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(buckets, model.value.reshape(2, ORDER + 1, 2, buckets))
        for batch in pieces(batches):
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts.ratio(batch.column(names.index("text"))))], [*names, "ratio"])

    seen = examples.where("fold = 0").select("text", "side").mapInArrow(scored, "text string, side int, ratio double")
    limit = _limit(seen)
    out = rows.withColumn("text", F.concat("host", "path")).mapInArrow(
        scored, "page_id long, host string, path string, rule string, decided string, text string, ratio double"
    )
    own = F.when((F.col("text") == "") | (F.col("ratio") >= limit), "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("decided", own).alias("verdict"), "ratio")


def _limit(seen: DataFrame) -> float:
    """Where balanced accuracy is best, of a fixed number of limits; 0 without examples of both sides."""
    bins = np.zeros((2, 2 * _BINS + 1))
    at = F.greatest(F.lit(-_BINS), F.least(F.lit(_BINS), F.floor(F.col("ratio") * _BINS / 4)))
    for r in seen.groupBy("side", at.alias("bin")).count().collect():  # at most 2 * (2 * _BINS + 1) rows
        bins[r["side"], r["bin"] + _BINS] += r["count"]
    if not bins.sum(axis=1).all():
        return 0.0
    below = np.cumsum(bins, axis=1) / bins.sum(axis=1, keepdims=True)
    gain = np.concatenate(([0.0], below[0] - below[1]))  # a limit at bin i rejects all bins below it
    best = np.flatnonzero(gain == gain.max())
    i = best[np.argmin(np.abs(best - _BINS))]
    return float((i - _BINS) * 4 / _BINS)
