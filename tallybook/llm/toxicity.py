"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words, hashed into ``BUCKETS`` buckets. The score is the sigmoid of
``bias + sum w_i + sum over pairs <v_i, v_j>``: the pair terms let two words together weigh more, or less, than each
alone (an insult beside the name of a group, an insult that is being quoted). The whole text is read.

The model is fitted on labelled rows only, at most ``MOST_LABELLED`` of them (those with the smallest hash of their
doc_id, a fixed sample), and never on held-out rows: those whose crc32 of the doc_id as text is divisible by 5. Rows that
repeat a text count once. Only the hashed terms of these rows come to the driver. Weights with little support are shrunk to zero, so that
the thousands of neutral words of a long text add nothing; the model that is broadcast has a fixed size.

Defined cases: null, empty and blank texts have no terms and get the score of the bias; labels that are null, or of no
document, are passed over; a document with several labels is toxic if one says so; without labels of both kinds
the score of every text is the share of toxic labels; a null doc_id is not held out and not learned from; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.tables import unused
from tallybook.llm.tokens import PUNCTUATION, Words, pieces

BUCKETS = 1 << 18
FACTORS = 4
MOST_LABELLED = 20_000
EPOCHS = 12
#: A term learns only if it occurs in as many of the labelled texts, and its share of toxic texts, or that of a pair, stands out.
LEAST_TEXTS = 4
#: So many of the most frequent terms are also looked at in pairs: a term may stand out only beside another.
PAIR_TERMS = 2048


@dataclass
class Machine:
    bias: float
    slot: np.ndarray  # for each bucket its row in weight and factor, or -1
    weight: np.ndarray
    factor: np.ndarray

    def scores(self, terms: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Of texts whose buckets, without repeats, lie end to end."""
        doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        at = self.slot[terms]
        doc, at = doc[at >= 0], at[at >= 0]
        return _sigmoid(self._raw(at, doc, len(begin) - 1)[0])

    def _raw(self, at: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        linear = np.bincount(doc, self.weight[at], n)
        sums = np.stack([np.bincount(doc, self.factor[at, k], n) for k in range(self.factor.shape[1])], axis=1)
        squares = np.bincount(doc, (self.factor[at] ** 2).sum(axis=1), n)
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2, sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, ascending, and where each text's begin."""
    bucket = (words.hash >> np.uint64(64 - 18)).astype(np.int64)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    both = np.unique(doc * BUCKETS + bucket)
    return both % BUCKETS, np.searchsorted(both // BUCKETS, np.arange(len(words.first)))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Machine:
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    # The smallest hashes are found on the small table of labels; only these rows' texts are joined.
    marks = marks.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            terms, begin = _terms(Words(batch.column(1), PUNCTUATION))
            rows = [terms[a:b].astype(np.int32).tobytes() for a, b in zip(begin[:-1], begin[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["toxic", "terms"])

    # A fixed bound of rows, so the labelled side may be broadcast.
    chosen = texts.join(F.broadcast(marks), "doc_id").select("toxic", "text").mapInArrow(hashed, "toxic int, terms binary")
    rows = chosen.groupBy("terms").agg(F.max("toxic").alias("toxic")).orderBy("terms").limit(most)
    return learn(*_flat(rows.toArrow()))


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """toxic of each row, the terms of all end to end, and the row of each: no object a row, which the driver would not give back."""
    terms = [x.cast(pa.large_binary()) for x in rows.column("terms").chunks if len(x)]
    ends = [np.frombuffer(x.buffers()[1], dtype=np.int64)[x.offset : x.offset + len(x) + 1] for x in terms]
    data = [np.frombuffer(x.buffers()[2], dtype=np.uint8)[e[0] : e[-1]] for x, e in zip(terms, ends) if e[-1] > e[0]]
    size = np.concatenate([np.zeros(0, np.int64), *[np.diff(e) for e in ends]]) // 4
    term = np.concatenate([np.zeros(0, np.uint8), *data]).view(np.int32)
    target = rows.column("toxic").to_numpy().astype(float)
    return target, term, np.repeat(np.arange(len(size), dtype=np.int32), size)


def learn(target: np.ndarray, term: np.ndarray, doc: np.ndarray, seed: int = 7) -> Machine:
    """Fit by AdaGrad on whole passes in fixed small batches; the same rows always give the same model."""
    n, toxic = len(target), target.sum()
    share = min(max((toxic + 1) / (n + 2), 0.01), 0.99)
    machine = Machine(float(np.log(share / (1 - share))), np.full(BUCKETS, -1, np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < toxic < n:
        return machine
    seen = np.bincount(term, minlength=BUCKETS)
    bad = np.bincount(term, target[doc], BUCKETS)
    mean = toxic / n
    apart = (bad - seen * mean) / np.sqrt(seen * mean * (1 - mean) + 1e-9)
    use = np.union1d(np.flatnonzero((seen >= LEAST_TEXTS) & (np.abs(apart) > 4)), _paired(target, term, doc, seen, bad, mean))
    if not len(use):
        return machine
    machine.slot[use] = np.arange(len(use))
    rng = np.random.default_rng(seed)
    machine.weight = np.zeros(len(use))
    machine.factor = rng.normal(0, 0.05, (len(use), FACTORS))
    at = machine.slot[term]
    doc, at = doc[at >= 0], at[at >= 0]
    first = np.searchsorted(doc, np.arange(n + 1))
    balance = np.where(target > 0, min((n - toxic) / toxic, 4.0), 1.0)
    gw, gv, gb = np.full(len(use), 1e-2), np.full((len(use), FACTORS), 1e-2), 1e-2
    for _ in range(EPOCHS):
        for some in np.array_split(rng.permutation(n), max(1, n // 64)):
            size = first[some + 1] - first[some]
            local = np.repeat(np.arange(len(some)), size)
            where = np.arange(len(local)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[some], size)
            terms = at[where]
            raw, sums = machine._raw(terms, local, len(some))
            error = (_sigmoid(raw) - target[some]) * balance[some]
            own, back = np.unique(terms, return_inverse=True)
            step = np.bincount(back, error[local], len(own)) + 1e-3 * machine.weight[own]
            pull = error[local, None] * (sums[local] - machine.factor[terms])
            push = np.stack([np.bincount(back, pull[:, k], len(own)) for k in range(FACTORS)], axis=1) + 1e-2 * machine.factor[own]
            gw[own] += step**2
            gv[own] += push**2
            gb += error.sum() ** 2
            machine.weight[own] -= 0.3 * step / np.sqrt(gw[own])
            machine.factor[own] -= 0.05 * push / np.sqrt(gv[own])
            machine.bias -= 0.1 * error.sum() / np.sqrt(gb)
    return machine


def _paired(target: np.ndarray, term: np.ndarray, doc: np.ndarray, seen: np.ndarray, bad: np.ndarray, mean: float) -> np.ndarray:
    """Terms of the pairs whose texts are toxic otherwise than the two terms by themselves, added up, would have it."""
    common = np.argsort(-seen, kind="stable")[:PAIR_TERMS]
    common = common[seen[common] >= LEAST_TEXTS]
    place = np.full(BUCKETS, -1, np.int64)
    place[common] = np.arange(len(common))
    both, toxic = np.zeros((2, len(common), len(common)), dtype=np.float32)
    begin = np.searchsorted(doc, np.arange(len(target) + 1))
    for a in range(0, len(target), 1024):  # counts of pairs, some texts at a time
        rows = slice(begin[a], begin[min(a + 1024, len(target))])
        at = place[term[rows]]
        some = np.zeros((min(1024, len(target) - a), len(common)), dtype=np.float32)
        some[doc[rows][at >= 0] - a, at[at >= 0]] = 1
        both += some.T @ some
        bad_rows = some[target[a : a + 1024] > 0]
        toxic += bad_rows.T @ bad_rows
    share = (bad[common] + mean) / (seen[common] + 1)
    odds = np.log(share / (1 - share))
    most = np.zeros(len(common))
    for i in range(len(common)):  # a row at a time, for the driver's memory
        expected = _sigmoid(odds[i] + odds - np.log(mean / (1 - mean)))
        apart = np.abs(toxic[i] - both[i] * expected) / np.sqrt(both[i] * expected * (1 - expected) + 1)
        apart[i] = 0
        most[i] = apart.max()
    return common[most > 6]


def scored(docs: DataFrame, machine: Machine, name: str = "toxicity") -> DataFrame:
    """``docs`` (all columns) with the score, a double from 0 to 1, as a further column ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            text = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            score = model.value.scores(*_terms(Words(text, PUNCTUATION)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(texts, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the fitted machine scores 0.5 or more."""
    name = unused(docs, "toxicity")
    return scored(docs, fit(docs, labels), name).where(F.col(name) < 0.5).drop(name)
