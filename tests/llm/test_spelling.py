"""Spelling variants against brute force, with small limits so that keys are halved, and the cases of the docstring."""

import random
import re
import zlib
from collections import Counter

import pytest

from tallybook.llm import spelling as op

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def expected(rows, least=7, ratio=10):
    count = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 2}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variant(rnd, word):
    at = rnd.randrange(len(word))
    return rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice("abé") + word[at:], word[:at] + rnd.choice("abé") + word[at + 1 :]])


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(6, 9))) for _ in range(40)]
    for _ in range(300):
        words.append(variant(rnd, rnd.choice(words)))
    words += [f"prefix{a}{b}" for a in "abcdefgh" for b in "abcdefgh"] + [f"{a}{b}suffixes" for a in "abcdefgh" for b in "ab"]
    out = []
    for i in range(60):
        picked = [rnd.choice(words) for _ in range(60)] + [words[i % 7]] * rnd.choice([1, 30, 400])
        rnd.shuffle(picked)
        out.append((i, "".join((w.upper() if rnd.random() < 0.1 else w) + rnd.choice([" ", "7", ", ", " "]) for w in picked)))
    out += [(100, None), (101, ""), (None, "wordless wordless wordlesss wordlesss"), (5, out[5][1]), (102, "x" * 30_000), (103, "x" * 30_000), (104, "×÷×÷×÷×÷ ×÷×÷×÷×÷")]
    return out


@pytest.mark.parametrize("most", [1, 8, op.MOST])
def test_against_brute_force(spark, rows, most):
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = {tuple(r) for r in op.variants(docs.repartition(4), most=most).collect()}
    want = expected(rows)
    assert got == want and len(want) > 200 and max(w[4] for w in want) > 5


def test_chains_of_forms(spark):
    counts = {"abcdefgh": 2, "abcdefgx": 20, "abcdefyx": 200, "abcdezyx": 2000, "abcdezyxx": 2000}
    rows = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(counts.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in op.variants(docs).collect()}
    assert got == expected(rows) and {r[2] for r in got if r[0] == "abcdefgh"} == {"abcdezyx"}


def test_lists_in_many_batches(spark):
    words = sorted({f"w{i:06d}x".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(0, 100_000, 3)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        pairs = op.near_words(table, most=64).distinct().count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    have = set(words)
    want = sum(w[:i] + c + w[i + 1 :] in have for w in words for i in range(1, 7) for c in "abcdefghij" if c != w[i])
    assert pairs == want


def test_empty_table(spark):
    assert op.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
