"""Secret scan: fixed patterns, and strings that a tokenizer can't shorten.

Text that people write is covered by a byte-pair vocabulary at about four characters a token; random strings get fewer
than two. Every run of at least ``least`` key characters is a candidate if it mixes letters and digits. It is passed
over if it is a known digest (a hash of usual length in hexadecimal, which the ``hex`` pattern lists anyway) or an
identifier: a UUID, a number, a path, an address, or a name whose parts are words. Of the rest, those with fewer than ``most_ratio``
characters a token are spans of kind ``random``. Spans that overlap one of a fixed pattern are not listed twice.

The fixed patterns are found as they stand, leftmost and not overlapping in each kind, over whole texts. Offsets are
code points. The vocabulary file is read where the driver is and broadcast (its size is fixed: one file of about 50,000 ranks).

Defined cases: null is empty; an empty text has no spans; repeated rows come back repeated; other columns are ignored
by ``secret_spans`` and kept by ``redact``; a text of any length is scanned whole, its tokens counted piece by piece.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.tokens import joined, pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the public vocabulary splits text before merging (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_RATIO = 2.0
LEAST_CHARACTERS = 20
REDACTED = "[REDACTED]"
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HINTS = (b"passw", b"secret", b"token", b"api")
_HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
_KEY_BYTES = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"))
#: Known digests: md5, sha-1, sha-224, sha-256, sha-384, sha-512 in hexadecimal.
_DIGEST = re.compile(r"(?i)(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z")
_UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\Z")
#: A part of a name: letters of one case, or capitalized, or digits, with at most a few digits at its end.
_PART = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)[0-9]{0,4}")
_SEPARATORS = re.compile(r"[_/=+-]+")
_PIECE = 4096


@functools.lru_cache(maxsize=1)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})


def characters_per_token(text: str, ranks: bytes) -> float:
    encode = _encoding(ranks).encode_ordinary
    return len(text) / max(1, sum(len(encode(text[a : a + _PIECE])) for a in range(0, len(text), _PIECE)))


def is_name(text: str) -> bool:
    """Whether all parts between separators are those of names; each part is looked at by itself, so in linear time."""
    parts = _SEPARATORS.split(text)
    return all(_PART.fullmatch(p) for p in (parts[:-1] if len(parts) > 1 and not parts[-1] else parts))


def is_random(text: str, ranks: bytes, most_ratio: float) -> bool:
    if not re.search("[0-9]", text) or not re.search("[A-Za-z]", text):
        return False
    if _DIGEST.match(text) or _UUID.match(text) or is_name(text):
        return False
    return characters_per_token(text, ranks) < most_ratio


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    mark = np.concatenate(([False], inside, [False]))
    edge = np.flatnonzero(mark[1:] != mark[:-1])
    start, end = edge[0::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def _scan(texts: pa.Array, ranks: bytes, most_ratio: float, least: int) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, kind, end) in code points, sorted."""
    data, offsets = joined(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]

    def add(kind: int, start: np.ndarray, end: np.ndarray) -> None:
        for doc, a, b in zip((np.searchsorted(offsets, start, side="right") - 1).tolist(), start.tolist(), end.tolist()):
            found[doc].append((a, kind, b))

    raw = data.tobytes()
    low = raw.lower()
    for kind, pattern, hints, size in ((0, _ASSIGN, _HINTS, 12), (1, _ACCESS, (b"akia",), 18)):
        # Words and assignments can't reach over the zero byte between texts.
        for doc in sorted({d for hint in hints for d in _where(low, hint, offsets)}):
            a, b = int(offsets[doc]), int(offsets[doc + 1]) - 1
            for m in pattern.finditer(raw, a, b):
                if len(m[m.lastindex or 0]) >= size:
                    found[doc].append((m.start(), kind, m.end()))
    add(2, *_runs(_HEX_BYTES[data], 16))
    start, end = _runs(_KEY_BYTES[data], least)
    some = [(a, b) for a, b in zip(start.tolist(), end.tolist()) if is_random(raw[a:b].decode(), ranks, most_ratio)]
    for doc, (a, b) in zip((np.searchsorted(offsets, [a for a, _ in some], side="right") - 1).tolist(), some):
        if not any(x < b and a < y for x, _, y in found[doc]):
            found[doc].append((a, 3, b))
    points = None
    for doc, spans in enumerate(found):
        if spans:
            if points is None:
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            base = points[offsets[doc]]
            found[doc] = sorted((int(points[a] - base), kind, int(points[b] - base)) for a, kind, b in spans)
    return found


def _where(low: bytes, hint: bytes, offsets: np.ndarray) -> set[int]:
    at, docs = low.find(hint), set()
    while at >= 0:
        doc = int(np.searchsorted(offsets, at, side="right")) - 1
        docs.add(doc)
        at = low.find(hint, int(offsets[doc + 1]))
    return docs


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _vocabulary(docs: DataFrame, path: str):
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def secret_spans(docs: DataFrame, vocabulary: str = VOCABULARY, most_ratio: float = MOST_RATIO, least: int = LEAST_CHARACTERS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random for each row of ``docs``."""
    ranks = _vocabulary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = _scan(batch.column(1), ranks.value, most_ratio, least)
            counts = [pa.array([sum(k == kind for _, k, _ in s) for s in found], pa.int64()) for kind in range(4)]
            base = [hashlib.sha256(_joined([x for x in s if x[1] < 3]).encode()).hexdigest() for s in found]
            columns = [batch.column(0), *counts[:3], pa.array(base), pa.array([_joined(s) for s in found]), counts[3]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, vocabulary: str = VOCABULARY, most_ratio: float = MOST_RATIO, least: int = LEAST_CHARACTERS) -> DataFrame:
    """``docs`` with every span, overlapping ones together, replaced by ``REDACTED``, and ``n_chars`` counted anew."""
    ranks = _vocabulary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(_scan(batch.column(at), ranks.value, most_ratio, least)):
                out, last = [], 0
                for a, _, b in spans:
                    if a >= last:
                        out += [texts[i][last:a], REDACTED]
                    last = max(last, b)
                if spans:
                    texts[i] = "".join(out) + texts[i][last:]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
