"""Personal data: patterns against plain regular expressions, and what the skip chain adds."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tallybook.llm import personal_data as op

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            good = (
                True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 12 <= len(digits) <= 19 and sum(double) % 10 == 0, 9 <= len(digits) <= 15,
            )[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def listed(spans):
    return ",".join(f"{op.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def model():
    return op.fitted([])


def test_patterns_are_the_plain_ones():
    rnd = random.Random(5)
    for _ in range(30_000):
        text = "".join(rnd.choice("a1.@+- 20(9é\n") for _ in range(rnd.randint(0, 40)))
        assert op.base_spans(text) == base(text), text


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "a@" * 100_000, "1." * 200_000, "+1" * 200_000, "1 " * 200_000, "a.b@c." * 50_000):
        op.base_spans(text)
        op._scanned([text])
    assert time.perf_counter() - start < 20


def score(model, docs):
    texts = [t for t, _ in docs]
    scanned = op._scanned(texts)
    hit = miss = false = 0
    for (_, truth), (_, known), added in zip(docs, scanned, op.further_spans(texts, scanned, model)):
        assert not any(a < y and x < b for a, _, b in added for x, _, y in known)
        for a, kind, b in truth:
            if not any(x < b and a < y for x, _, y in known):
                found = any(x < b and a < y and k == kind for x, k, y in added)
                hit, miss = hit + found, miss + (not found)
        false += sum(not any(a < y and x < b and k == kind for x, k, y in truth) for a, kind, b in added)
    return hit / (hit + miss), hit / max(hit + false, 1)


def test_respelled_mentions_are_found_by_the_skip_chain(model):
    docs = op.made_documents([], 500, seed=99)
    recall, precision = score(model, docs)
    assert recall > 0.8 and precision > 0.95
    chain_only = op.Model(model.unary, model.pairs * np.array([1, 0, 0])[:, None, None])
    assert score(chain_only, docs)[0] < recall - 0.3


def test_labels_reach_distant_tokens(model):
    words = " ".join(["plain words of a text"] * 300)
    number = "4417 7442 8035 1547 "
    while not op.luhn(number.replace(" ", "")):
        number = number[:-2] + str((int(number[-2]) + 1) % 10) + " "
    digits = number.replace(" ", "")
    same = digits[:5] + str((int(digits[5]) + 1) % 10) + digits[6:]  # a slip, so no card number by itself
    mail = "zed.quill@mail.example.com"
    text = f"{number}{words} {mail} {words} {same} {words} zed.quill, {words} +1 (017) 555-7713 {words} 555-7713"
    clean = f"{words} {same} {words} zed.quill, {words} 555-7713"
    scanned = op._scanned([text, clean])
    added, alone = op.further_spans([text, clean], scanned, model)
    assert {(op.KINDS[k], text[a:b]) for a, k, b in added} == {("card", same), ("email", "zed.quill"), ("phone", "555-7713")}
    assert alone == []


def test_texts_without_personal_data_are_left_alone(model):
    rnd = random.Random(1)
    texts = [" ".join(op._made_number(rnd) if rnd.random() < 0.05 else op._made_word(rnd, 2, 9) for _ in range(120)) for _ in range(300)]
    scanned = op._scanned(texts)
    added = op.further_spans(texts, scanned, model)
    assert sum(map(bool, added)) <= 9


def test_query_rows(spark):
    rows = [
        (1, "write to a.b@c.example.com, or a.b@c"), (2, "+1 (017) 555-7713 and 10.0.0.256 and 10.0.0.25"), (3, None), (4, ""), (None, "é 4417774428035154 é 192.168.1.77"),
        (5, "same"), (5, "same"), (6, "x@y.zz " * 3000),
    ]
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, n_ip int, spans string")
    got = sorted((tuple(r)[:7] for r in op.personal_spans(docs).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        spans = base(text)
        digest = hashlib.sha256(listed(spans).encode()).hexdigest()
        want.append((doc_id, *(sum(k == kind for _, k, _ in spans) for kind in range(4)), digest))
    assert [g[:6] for g in got] == sorted(want, key=repr)
    for g in got:
        text = next(t for i, t in rows if i == g[0])
        assert set(filter(None, listed(base(text)).split(","))) <= set(g[6].split(","))
    assert op.personal_spans(docs.limit(0)).collect() == []
