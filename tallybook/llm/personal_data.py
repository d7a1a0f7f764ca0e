"""Personal data: fixed patterns, and a skip-chain conditional random field for mentions that the patterns miss.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers as they stand. Writers repeat themselves in
other spellings: a phone number without its prefix, a card number with a slip, the name before an @. In a document by
itself such a string could be anything; beside the full mention it is the same person's data.

Model. Nodes are tokens with a digit or ``@``, and words that are the local part of an address in the document. Labels are
none and the four kinds. Potentials: features of a token's shape; a table for neighbouring tokens (the chain); a table for tokens of the same normal form, and one for similar
forms (one digit differs, or the last seven digits agree), however far apart (the skip chain). All tokens of a form are joined to one of them, a pattern's if
there is one, so edges are as many as tokens. Tokens inside a pattern's span have its label; loopy belief propagation carries
it along the edges through the whole document, and tokens whose belief in a kind is ``LEAST_BELIEF`` or more become further spans, adjacent ones of a kind together.

Training. Pseudo-likelihood, which is convex, by gradient steps on the driver, over ``FIT_MADE`` made documents: words and numbers around
digits in a sample of ``FIT_DOCS`` documents (those of smallest hash; at most ``FIT_WORDS`` words of each are taken), with made
mentions, repeats of them in other spellings, and numbers that are nobody's. This is the only sample; every text is scanned whole.

Defined cases: null is empty; an empty text has no spans; repeated rows come back repeated; other columns are ignored;
a text of any length is scanned whole in time linear in it (runs of digits or letters are never scanned twice). An empty table trains on made words alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.tokens import joined, pieces

KINDS = ("email", "ip", "card", "phone")
FIT_DOCS = 4000
FIT_WORDS = 40
FIT_MADE = 4000
ROUNDS = 30
LEAST_BELIEF = 0.7

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_MARKS = np.isin(np.arange(256), list(b"0123456789@"))
_EDGE = re.compile(r"^[^0-9A-Za-z\u0080-\U0010ffff]+|[^0-9A-Za-z\u0080-\U0010ffff]+$")

Span = tuple[int, int, int]  # start, kind, end


# Patterns


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ is tried with the characters before it, back to the last match; none of them is looked at for two @."""
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[Span]:
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(found)


# Nodes and edges of documents


class Graph(NamedTuple):
    """Of any number of documents: node = (document, start, end), its features, its fixed label or -1, and edges by type."""

    doc: list[int]
    start: list[int]
    end: list[int]
    features: list[list[int]]
    fixed: list[int]
    edges: list[list[tuple[int, int]]]  # chain (left, right), same form, similar form


def _bucket(n: int, bounds: tuple[int, ...]) -> int:
    return sum(n >= b for b in bounds)


_DIGITS, _LETTERS, _FEW = (1, 3, 4, 5, 7, 9, 11, 12, 16, 17, 20), (1, 4, 10), (1, 2, 3, 4)
_SIZES = (1, len(_DIGITS) + 1, len(_LETTERS) + 1, len(_FEW) + 1, len(_FEW) + 1, 2, 2, 2, 2, 2, 2, 2, 2, 2)
_OFFSETS = np.concatenate(([0], np.cumsum(_SIZES)))
N_FEATURES = int(_OFFSETS[-1])
_AT = re.compile(r"(?i)[\[({]\s*at\s*[\])}]")


def _features(token: str, before: bool, after: bool) -> list[int]:
    """One feature of each group."""
    digits = "".join(_DIGIT.findall(token))
    groups = re.findall(r"[0-9]+", token) if len(digits) < 20 else []
    letters = sum(c.isalpha() for c in token[:100])
    values = (
        0, _bucket(len(digits), _DIGITS), _bucket(letters, _LETTERS), _bucket(token.count("."), _FEW), _bucket(token.count("-"), _FEW),
        "@" in token, "+" in token, "(" in token or ")" in token, "/" in token or ":" in token, bool(_AT.search(token)),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), 12 <= len(digits) <= 19 and luhn(digits), before, after,
    )
    return [int(o) + int(v) for o, v in zip(_OFFSETS, values)]


def _stripped(token: str) -> str:
    return _EDGE.sub("", token).lower()


def _name(token: str) -> str:
    """The token, or what stands before a spelled-out @."""
    at = _AT.search(token)
    return _stripped(token[: at.start()] if at else token)


def _forms(token: str) -> tuple[list, list]:
    """Keys that same tokens share, and keys that similar ones share."""
    digits, word = "".join(_DIGIT.findall(token)), _stripped(token)
    same, near = [], []
    if len(digits) >= 5 and len(digits) >= len(word) // 2:
        same.append(digits)
        if 7 <= len(digits) <= 15:
            near.append(("tail", digits[-7:]))
        if 8 <= len(digits) <= 19:
            near += [(i, digits[:i], digits[i + 1 :]) for i in range(len(digits))]
    elif len(word) >= 4 and not word.isdigit():
        same.append(_name(token))
    return same, near


def graph(docs: Iterable[tuple[str, list[tuple[int, int, int]], list[Span]]]) -> Graph:
    """``docs``: text, nodes (start, end, number of the token in the document) in order, spans of the patterns."""
    g = Graph([], [], [], [], [], [[], [], []])
    for number, (text, nodes, spans) in enumerate(docs):
        groups: list[defaultdict[object, list[int]]] = [defaultdict(list), defaultdict(list)]
        first, at, reach = len(g.doc), 0, 0
        last_of_span: dict[int, int] = {}
        for i, (a, b, place) in enumerate(nodes):
            node, token = first + i, text[a:b]
            while at < len(spans) and spans[at][2] <= a:
                at += 1
            hit = next((s for s in range(at, len(spans)) if spans[s][0] < b and spans[s][2] > a), -1) if at < len(spans) and spans[at][0] < b else -1
            before = i > 0 and nodes[i - 1][2] == place - 1
            after = i + 1 < len(nodes) and nodes[i + 1][2] == place + 1
            g.doc.append(number)
            g.start.append(a)
            g.end.append(b)
            g.features.append(_features(token, before, after))
            g.fixed.append(-1 if hit < 0 else spans[hit][1] + 1)
            if before:
                g.edges[0].append((node - 1, node))
            same, near = _forms(token)
            if hit >= 0 and last_of_span.get(hit) is None:
                last_of_span[hit] = node
                whole = text[spans[hit][0] : spans[hit][2]]
                if spans[hit][1] == 0:
                    same.append(_stripped(whole.split("@")[0]))
                elif whole != token:  # a mention of some tokens: its first one stands for all
                    more = _forms(whole.replace(" ", ""))
                    same, near = same + more[0], near + more[1]
            for keys, group in zip((same, near), groups):
                for key in dict.fromkeys(keys):
                    group[key].append(node)
        linked = set()
        for kind, group in enumerate(groups, 1):
            for members in group.values():
                if len(members) > 1:
                    centre = next((n for n in members if g.fixed[n] >= 0), members[0])
                    for n in members:
                        pair = (min(n, centre), max(n, centre))
                        if n != centre and pair not in linked:
                            linked.add(pair)
                            g.edges[kind].append(pair)
    return g


# The model


class Model(NamedTuple):
    unary: np.ndarray  # features x labels
    pairs: np.ndarray  # chain, same, similar: labels x labels


_LABELS = len(KINDS) + 1


def _shapes(g: Graph) -> np.ndarray:
    out = np.zeros((len(g.doc), N_FEATURES))
    np.put_along_axis(out, np.array(g.features, dtype=np.int64).reshape(len(g.doc), -1), 1.0, axis=1)
    return out


def _edges(g: Graph) -> list[np.ndarray]:
    return [np.array(e, dtype=np.int64).reshape(-1, 2) for e in g.edges]


def train(g: Graph, labels: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Pseudo-likelihood of the labels of the tokens that no pattern covers, given those of their neighbours; Adam on the whole set."""
    features, edges = _shapes(g), _edges(g)
    open_ = np.array(g.fixed) < 0
    truth = np.eye(_LABELS)[labels]
    # A chain edge is seen by its left node and by its right node; skip edges are the same from both ends.
    seen = [np.zeros((len(labels), _LABELS)) for _ in range(4)]
    for k, (one, two) in enumerate(e.T for e in edges):
        np.add.at(seen[k if k else 3], one, truth[two])  # seen[3]: labels to the right in the chain
        np.add.at(seen[k], two, truth[one])
    unary, pairs = np.zeros((N_FEATURES, _LABELS)), np.zeros((3, _LABELS, _LABELS))
    params, state = [unary, pairs], [[np.zeros_like(unary), np.zeros_like(unary)], [np.zeros_like(pairs), np.zeros_like(pairs)]]
    for t in range(1, steps + 1):
        score = features @ unary + seen[0] @ pairs[0] + seen[3] @ pairs[0].T + seen[1] @ pairs[1] + seen[2] @ pairs[2]
        p = np.exp(score - score.max(axis=1, keepdims=True))
        error = (truth - p / p.sum(axis=1, keepdims=True)) * open_[:, None] / max(open_.sum(), 1)
        by_feature = features.T @ error
        by_pair = np.stack([seen[0].T @ error + error.T @ seen[3], seen[1].T @ error, seen[2].T @ error])
        by_pair[1:] = (by_pair[1:] + by_pair[1:].transpose(0, 2, 1)) / 2
        for x, slope, (m, v) in zip(params, (by_feature, by_pair), state):
            slope = slope - decay * x
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            x += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(unary, pairs)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def beliefs(g: Graph, model: Model, rounds: int = ROUNDS) -> np.ndarray:
    """Probability of each label at each node, by sum-product messages along all edges at once, damped by half."""
    own = _shapes(g) @ model.unary
    fixed = np.array(g.fixed)
    held = fixed >= 0
    own[held] = -50.0
    own[held, fixed[held]] = 0.0
    edges = _edges(g)
    source = np.concatenate([x for e in edges for x in (e[:, 0], e[:, 1])])
    target = np.concatenate([x for e in edges for x in (e[:, 1], e[:, 0])])
    back = np.concatenate([np.concatenate((np.arange(len(e)) + len(e), np.arange(len(e)))) + 2 * sum(map(len, edges[:k])) for k, e in enumerate(edges)]).astype(np.int64)
    table = np.repeat(np.stack([t for p in model.pairs for t in (p, p.T)]), [len(e) for e in edges for _ in (0, 1)], axis=0)
    message = np.zeros((len(source), _LABELS))
    total = own.copy()
    for _ in range(rounds if len(source) else 0):
        total = own.copy()
        np.add.at(total, target, message)
        sent = _lse((total[source] - message[back])[:, :, None] + table, axis=1)
        sent -= _lse(sent, axis=1)[:, None]
        moved = np.abs(sent - message).max()
        message += 0.5 * (sent - message)
        if moved < 1e-3:
            break
    total = own.copy()
    np.add.at(total, target, message)
    return np.exp(total - _lse(total, axis=1)[:, None])


# Made documents


def _made_mention(rng: random.Random, kind: int) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == 0:
        return f"{_made_word(rng, 4, 10)}{rng.choice(['', '.', '_'])}{rng.choice(['', digits(2)])}@{_made_word(rng, 3, 9)}.{rng.choice(['com', 'org', 'net', 'example.com'])}"
    if kind == 1:
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == 2:
        body = digits(15)
        number = next(body + d for d in "0123456789" if luhn(body + d))
        return number if rng.random() < 0.6 else rng.choice([" ", "-"]).join(number[i : i + 4] for i in range(0, 16, 4))
    area, one, two = digits(3), digits(3), digits(4)
    return f"+{rng.randint(1, 99)}" + rng.choice([f" ({area}) {one}-{two}", f"-{area}-{one}-{two}", f" {area} {one} {two}", f"{area}{one}{two}"])


def _made_word(rng: random.Random, low: int, high: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))


def _respelled(rng: random.Random, kind: int, mention: str) -> str:
    """The same data in a spelling that no pattern finds."""
    digits = "".join(_DIGIT.findall(mention))
    if kind == 0:
        local, host = mention.split("@")
        return rng.choice([local, f"{local}[at]{host}", f"{local}(at){host}"])
    if kind == 1:
        return mention.replace(".", rng.choice(["-", "_", ":"]))
    if kind == 2:
        at = rng.randrange(16)
        slip = digits[:at] + str((int(digits[at]) + rng.randint(1, 9)) % 10) + digits[at + 1 :]
        return rng.choice([slip, rng.choice("./_").join(digits[i : i + 4] for i in range(0, 16, 4))])
    area, one, two = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({area}) {one}-{two}", f"{area}-{one}-{two}", f"{one}-{two}", area + one + two, f"{one}.{two}"])


def _made_number(rng: random.Random) -> str:
    """Digits that are nobody's."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        digits(rng.randint(1, 6)), digits(rng.randint(7, 20)), digits(16), digits(rng.randint(13, 16)), f"{digits(3)}-{digits(4)}", f"{digits(2)}.{digits(2)}", f"{rng.randint(1990, 2030)}-{digits(2)}-{digits(2)}",
        f"{digits(2)}:{digits(2)}", f"{digits(1)}.{digits(2)}.{digits(3)}", "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(8, 40))), f"#{digits(8)}", f"{_made_word(rng, 2, 6)}{digits(2)}",
    ])


def made_documents(contexts: list[list[str]], count: int, seed: int = 0) -> list[tuple[str, list[Span]]]:
    """Texts, and the spans of the respelled mentions in them. Words are those of ``contexts``."""
    rng = random.Random(seed)
    pool = [w for c in contexts for w in c if w.isalpha()] or [_made_word(rng, 2, 9) for _ in range(200)]
    numbers = [w for c in contexts for w in c if _DIGIT.search(w)]
    out = []
    for _ in range(count):
        parts: list[tuple[str, int]] = [(rng.choice(pool), -1) for _ in range(rng.randint(5, 40))]
        put = lambda text, kind: parts.insert(rng.randint(0, len(parts)), (text, kind))  # noqa: E731, B023
        for _ in range(rng.choice([0, 1, 1, 2])):
            kind = rng.randrange(4)
            mention = _made_mention(rng, kind)
            put(mention, -1)
            for _ in range(rng.choice([0, 1, 1, 2])):
                put(_respelled(rng, kind, mention), kind)
        for _ in range(rng.randint(0, 6)):
            number = rng.choice(numbers) if numbers and rng.random() < 0.4 else _made_number(rng)
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                put(number, -1)
        text, truth = "", []
        for part, kind in parts:
            if kind >= 0:
                truth.append((len(text), kind, len(text) + len(part)))
            text += part + " "
        out.append((text, truth))
    return out


def fitted(contexts: list[list[str]], made: int = FIT_MADE, seed: int = 0) -> Model:
    docs = made_documents(contexts, made, seed)
    given = [(text, nodes, spans) for (text, _), (nodes, spans) in zip(docs, _scanned([t for t, _ in docs]))]
    g = graph(given)
    labels = np.maximum(np.array(g.fixed), 0)
    for i, (d, a, b) in enumerate(zip(g.doc, g.start, g.end)):
        if g.fixed[i] < 0:
            labels[i] = next((kind + 1 for start, kind, end in docs[d][1] if start < b and a < end), 0)
    return train(g, labels)


# Scanning


def _scanned(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], list[Span]]]:
    """For each text its nodes and its patterns' spans, in code points."""
    data, offsets = joined(pa.array(texts, pa.string()))
    inside = ~_BLANK[data]
    inside[offsets[1:] - 1] = False
    mark = np.concatenate(([False], inside, [False]))
    edge = np.flatnonzero(mark[1:] != mark[:-1])
    start, end = edge[0::2], edge[1::2]
    marks = np.concatenate(([0], np.cumsum(_MARKS[data])))
    chosen = np.flatnonzero(marks[end] > marks[start])
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    first = np.searchsorted(start, offsets)
    doc = np.searchsorted(first, chosen, side="right") - 1
    out: list[tuple[list[tuple[int, int, int]], list[Span]]] = [([], []) for _ in texts]
    base = points[offsets]
    for d, a, b, place in zip(doc.tolist(), (points[start[chosen]] - base[doc]).tolist(), (points[end[chosen]] - base[doc]).tolist(), (chosen - first[doc]).tolist()):
        out[d][0].append((a, b, place))
    for d in np.unique(doc).tolist():
        text, (nodes, spans) = texts[d], out[d]
        spans += base_spans(text)
        locals_ = {local for a, kind, b in spans if kind == 0 and len(local := _stripped(text[a:b].split("@")[0])) >= 4 and not local.isdigit()}
        if locals_:
            have = {a for a, _, _ in nodes}
            for place, w in enumerate(range(first[d], first[d + 1])):
                a, b = int(points[start[w]] - base[d]), int(points[end[w]] - base[d])
                if a not in have and _name(text[a:b]) in locals_:
                    nodes.append((a, b, place))
            nodes.sort()
    return out


def further_spans(texts: list[str | None], scanned, model: Model) -> list[list[Span]]:
    """For each text the spans that belief propagation adds; none overlaps one of a pattern."""
    some = [d for d, (nodes, _) in enumerate(scanned) if nodes]
    out: list[list[Span]] = [[] for _ in texts]
    g = graph((texts[d], *scanned[d]) for d in some)
    if not g.doc:
        return out
    belief = beliefs(g, model)
    label = np.where(belief.max(axis=1) >= LEAST_BELIEF, belief.argmax(axis=1), 0)
    label[np.array(g.fixed) >= 0] = 0
    chained = {two for _, two in g.edges[0]}
    last = -2
    for i in np.flatnonzero(label).tolist():
        d, kind = some[g.doc[i]], int(label[i]) - 1
        a, b = g.start[i], g.end[i]
        token = texts[d][a:b]
        left, right = re.match(r"[^0-9A-Za-z\u0080-\U0010ffff(+]*", token).end(), re.search(r"[^0-9A-Za-z\u0080-\U0010ffff)]*\Z", token).start()
        if right <= left:
            continue
        a, b = a + left, a + right
        if last == i - 1 and i in chained and out[d] and out[d][-1][1] == kind:
            out[d][-1] = (out[d][-1][0], kind, b)
        else:
            out[d].append((a, kind, b))
        last = i
    return out


def _contexts(docs: DataFrame, fit_docs: int) -> list[list[str]]:
    """Words around digits, at most ``FIT_WORDS`` a document, of the ``fit_docs`` documents of smallest hash."""
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("h"))
    limit = hashed.select("h").orderBy("h").limit(fit_docs).agg(F.max("h")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                words = (text or "").split()
                near = [i for i, w in enumerate(words) if len(w) < 60 and _DIGIT.search(w)][:4]
                rows.append([w for i in near or [2] for w in words[max(i - 5, 0) : i + 5] if len(w) < 60][:FIT_WORDS])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["words"])

    if limit is None:
        return []
    rows = hashed.where(F.col("h") <= limit).select("text").mapInArrow(run, "words array<string>").limit(2 * fit_docs).collect()
    return sorted(r[0] for r in rows)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def personal_spans(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 (of the patterns), spans (all), n_further (the model's) for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fitted(_contexts(docs, fit_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column(1).to_pylist()
            scanned = _scanned(texts)
            more = further_spans(texts, scanned, model)
            counts = [pa.array([sum(k == kind for _, k, _ in spans) for _, spans in scanned], pa.int64()) for kind in range(4)]
            digest = pa.array([hashlib.sha256(_listed(spans).encode()).hexdigest() for _, spans in scanned], pa.string())
            every = pa.array([_listed(sorted(spans + further)) for (_, spans), further in zip(scanned, more)], pa.string())
            columns = [batch.column(0), *counts, digest, every, pa.array([len(f) for f in more], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_further"])

    return docs.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_further long")
