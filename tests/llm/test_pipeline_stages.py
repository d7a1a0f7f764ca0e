"""What each stage of the pipeline keeps, against a plain version of its rule on the smallest tables."""

import re

import pytest

import corpus_pipeline as pipeline
from tallybook.llm import mixing, secrets, toxicity
from tallybook.llm.tables import documents, stored

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = documents(spark, SMALL), []
    for name, stage in pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), f"test-{name}")
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_toxicity_drops_what_it_scores_half_or_more(spark, steps):
    before, after = steps[0]
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(before, documents(spark, SMALL, "labels")).collect()}
    assert set(texts(after)) == {i for i, toxic in scores.items() if not toxic}


def test_one_of_each_group_of_near_duplicates(steps):
    before, after = (texts(df) for df in steps[1])
    sets = {}
    for i, text in before.items():
        words = WORD.findall(low(text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    head = {i: i for i in sets}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                head[max(top(a), top(b))] = min(top(a), top(b))
    assert set(after) == {i for i in ids if top(i) == i}


def test_no_window_of_an_item_is_left(spark, steps):
    before, after = (texts(df) for df in steps[2])
    windows = set()
    for r in documents(spark, SMALL, "benchmark").collect():
        words = TOKEN.findall(low(r.text))
        windows |= {tuple(words[k : k + 10]) for k in range(max(len(words) - 9, 1))} if words else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        words = TOKEN.findall(low(text))
        return any(tuple(words[k : k + n]) in windows for n in sizes for k in range(len(words) - n + 1))

    assert set(after) <= set(before)
    clean = {i for i, text in before.items() if not hit(text)}
    assert clean <= set(after) and all(after[i] == before[i] for i in clean)


def test_secrets_are_masked_and_nothing_else(steps):
    before, after = steps[3]
    spans = {r.doc_id: r.spans for r in secrets.secret_spans(before).collect()}
    old, new = texts(before), texts(after)
    assert set(old) == set(new)
    for i, text in old.items():
        places = sorted(tuple(map(int, s.split(":")[1:])) for s in spans[i].split(",") if s)
        want, last = "", 0
        for a, b in places:
            if a >= last:
                want += text[last:a] + secrets.REDACTED
            last = max(last, b)
        assert new[i] == want + text[last:]


def test_the_mix_takes_each_document_as_often_as_it_says(steps):
    before, after = steps[4]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    got = {}
    for r in after.select("doc_id").collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in copies.items() if n} and max(copies.values()) <= 3
