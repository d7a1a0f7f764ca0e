"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks: the texts between block tags, in page order. Each block is a vector of its tag path (hashed
names, classes and ids of all open elements), of its words (hashed) and of a few measures. A bidirectional LSTM in
numpy reads the sequence, so a block's label depends on the blocks before and behind it, and on the whole page in the end.
Scripts, styles, comments and the head hold no blocks.

The labeller is trained here, on pages laid out at random from a bounded sample of the corpus: the words of the sampled
pages fill an article and the menus, headers, footers, sidebars, notices, adverts, forms and reader comments around and within it,
under many usual names. The generator knows each block's kind, so no hand labels are needed. The same sample gives the
same labeller.

Defined cases: null and empty html, and pages without main blocks, give an empty text; tags left open or closed twice,
upper-case tags and attributes without quotes are read; a head ends where something begins that it can't hold; a silent element
that is never closed silences nothing; a quote that is not closed before the next tag is no quote, so its tag ends at the next ``>``;
a tag that the page ends in is dropped;
a page of any length is read whole; repeated rows come back repeated; further columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLED_PAGES = 200
TRAINED_PAGES = 2400
EPOCHS = 8
HIDDEN = 12
PATH_BUCKETS, WORD_BUCKETS, MEASURES = 192, 32, 5
WIDTH = PATH_BUCKETS + WORD_BUCKETS + MEASURES
PAGES_AT_ONCE = 64

# HTML's elements by role.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head iframe noscript script style svg template textarea title".split())
RAW = frozenset("script style textarea title iframe".split())
#: What a head may hold; anything else ends it.
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: An element that ends an open one of the same kind.
ALONE = frozenset("dd dt li option p td th tr".split())

_TAG = re.compile(r"<(?:!--(?P<note>.*?)(?:-->|\Z)|[!?][^>]*>|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^'\">]|[\"'])*+)(?:>|\Z))", re.DOTALL)
_NAMES = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """(path names, text, share of the text in links) of each leaf block."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked = silent = 0
    links = 0
    path: tuple[str, ...] = ()
    at, n = 0, len(page)
    low = page.lower()
    last_end = {name: low.rfind(f"</{name}") for name in SILENT - RAW - {"head"}}

    def leave_head() -> None:
        """A head whose end tag is left out ends where something else begins."""
        nonlocal silent, path
        for k, (name, _) in enumerate(stack):
            if name == "head":
                silent -= sum(t in SILENT for t, _ in stack[k:])
                del stack[k:]
                path = stack[-1][1] if stack else ()
                break

    def close() -> None:
        nonlocal linked
        if texts:
            text = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
            if text:
                out.append((path, text, min(1.0, linked / len(text))))
            texts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if silent and stack[-1][0] == "head" and text.strip():
            leave_head()
        if text and not silent:
            texts.append(text)
            if links:
                linked += len(text)

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                links = 0 if m["end"] else 1
            elif name == "br":
                say(" ")
            continue
        close()
        if silent and not m["end"] and name not in IN_HEAD:
            leave_head()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    silent -= sum(t in SILENT for t, _ in stack[k:])
                    del stack[k:]
                    break
            path = stack[-1][1] if stack else ()
            links = 0
            continue
        if name in EMPTY or m["rest"].endswith("/") and name in ("path", "use"):
            continue
        if name in RAW:
            end = re.compile(rf"(?i)</{name}\b[^>]*>").search(page, at)
            at = end.end() if end else n
            continue
        if stack and (stack[-1][0] == "p" or name in ALONE and stack[-1][0] == name):
            stack.pop()  # no paragraph holds another block
        names = [name]
        for own in _NAMES.findall(m["rest"]):
            names += [f".{w}" for w in _WORD.findall("".join(own).lower())]
        path = (stack[-1][1] if stack else ()) + tuple(names)
        if name in last_end and last_end[name] < at:
            continue  # never closed: what follows is not its content
        stack.append((name, path))
        silent += name in SILENT
    close()
    return out


_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    have = _PATHS.get(path)
    if have is None:
        have = np.zeros(PATH_BUCKETS, dtype=np.float32)
        for name in path:
            if name not in ("html", "body"):
                have[zlib.crc32(name.encode()) % PATH_BUCKETS] = 1
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        _PATHS[path] = have
    return have


@functools.lru_cache(maxsize=1 << 16)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_BUCKETS


def vectors(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    out = np.zeros((len(page), WIDTH), dtype=np.float32)
    for i, (path, text, linked) in enumerate(page):
        out[i, :PATH_BUCKETS] = _path_vector(path)
        words = text.lower().split()
        counts = np.bincount([_bucket(w) for w in words], minlength=WORD_BUCKETS)
        out[i, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = 0.2 * np.sqrt(counts / max(1, len(words)))
        out[i, -MEASURES:] = (np.log1p(len(words)) / 4, linked, text[-1:] in ".!?", i / len(page), len(path) / 10)
    return out


class Labeller:
    """A bidirectional LSTM with one output for each block; all weights in one dictionary."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.w = {"out": rng.normal(0, 0.1, (2 * HIDDEN, 1)), "bias": np.zeros(1)}
        for side in ("fore", "back"):
            self.w[side] = rng.normal(0, 1 / np.sqrt(HIDDEN + 20), (WIDTH + HIDDEN, 4 * HIDDEN))
            self.w[side + "_bias"] = np.repeat([1.0, 0.0, 0.0, 0.0], HIDDEN)  # gates: forget, in, out, new
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _read(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """x: step, page, feature. States of finished or not yet begun pages stay zero."""
        weight, bias = self.w[side], self.w[side + "_bias"]
        steps, pages, _ = x.shape
        given = x @ weight[:WIDTH] + bias
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out, notes = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if side == "fore" else range(steps - 1, -1, -1):
            gate = given[t] + h @ weight[WIDTH:]
            sig = 1 / (1 + np.exp(-np.clip(gate[:, : 3 * HIDDEN], -30, 30)))
            new = np.tanh(gate[:, 3 * HIDDEN :])
            before_h, before_c, m = h, c, mask[t][:, None]
            c = (sig[:, :HIDDEN] * c + sig[:, HIDDEN : 2 * HIDDEN] * new) * m
            tanh = np.tanh(c)
            h = sig[:, 2 * HIDDEN :] * tanh * m
            out[t] = h
            if keep:
                notes.append((t, sig, new, before_h, before_c, tanh, m))
        return out, notes

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each block of each page, that it is main text."""
        x, mask = _padded(pages)
        state = np.concatenate([self._read(s, x, mask, False)[0] for s in ("fore", "back")], axis=2)
        raw = (state @ self.w["out"])[..., 0] + self.w["bias"]
        return [1 / (1 + np.exp(-np.clip(raw[: len(p), i], -30, 30))) for i, p in enumerate(pages)]

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        x, mask = _padded(pages)
        target = np.zeros(mask.shape, np.float32)
        for i, y in enumerate(labels):
            target[: len(y), i] = y
        reads = {s: self._read(s, x, mask, True) for s in ("fore", "back")}
        state = np.concatenate([reads[s][0] for s in ("fore", "back")], axis=2)
        raw = (state @ self.w["out"])[..., 0] + self.w["bias"]
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - target) * mask / mask.sum()
        grads = {"out": np.einsum("tph,tp->h", state, error)[:, None], "bias": np.array([error.sum()])}
        back = error[..., None] * self.w["out"][:, 0]
        for k, side in enumerate(("fore", "back")):
            weight, gw = self.w[side], np.zeros_like(self.w[side])
            dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
            gate_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            for t, sig, new, before_h, before_c, tanh, m in reversed(reads[side][1]):
                dh = (dh + back[t, :, k * HIDDEN : (k + 1) * HIDDEN]) * m
                dc = (dc + dh * sig[:, 2 * HIDDEN :] * (1 - tanh**2)) * m
                d = np.concatenate([dc * before_c, dc * new, dh * tanh], axis=1) * sig * (1 - sig)
                d = np.concatenate([d, dc * sig[:, HIDDEN : 2 * HIDDEN] * (1 - new**2)], axis=1)
                gate_all[t] = d
                gw[WIDTH:] += before_h.T @ d
                dh = d @ weight[WIDTH:].T
                dc = dc * sig[:, :HIDDEN]
            gw[:WIDTH] = np.tensordot(x, gate_all, axes=([0, 1], [0, 1]))
            grads[side], grads[side + "_bias"] = gw, gate_all.sum(axis=(0, 1))
        return grads

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = 4) -> None:
        rng, step = np.random.default_rng(seed), 0
        one, two = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        by_length = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        groups = [by_length[a : a + 32] for a in range(0, len(by_length), 32)]
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                step += 1
                grads = self.gradients([pages[i] for i in groups[g]], [labels[i] for i in groups[g]])
                for k, g_ in grads.items():  # Adam
                    one[k] = 0.9 * one[k] + 0.1 * g_
                    two[k] = 0.99 * two[k] + 0.01 * g_**2
                    self.w[k] = (self.w[k] - 0.02 * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
        mask[: len(p), i] = 1
    return x, mask


# Usual places of the parts of a page, as tag and class or id.
_MAIN = "article main div.content div#content div.post div.entry-content section.article-body div.story div.article div#main div.post-content section div div.text body".split()
_PARTS = {
    "menu": "nav ul.menu div.nav div#navbar div.menu ul.navigation div.breadcrumbs div.topbar nav.main-nav div.toc div#navigation".split(),
    "header": "header div.header div#header div.masthead div.site-header header.banner div.logo".split(),
    "footer": "footer div.footer div#footer div.copyright footer.site-footer div.bottom div.legal".split(),
    "sidebar": "aside div.sidebar div#sidebar div.widget div.related section.recommended aside.rail div.popular div.tags".split(),
    "notice": "div.cookie-notice div.notice div#cookie-banner div.alert div.consent div.popup div.newsletter div.gdpr section.notice div.warning".split(),
    "advert": "div.ad div.ads div.advert div.advertisement div.sponsored div.promo aside.ad div#banner-ad div.sponsor ins.adsbygoogle".split(),
    "form": "form form.search form#login form.subscribe div.form form.contact".split(),
    "comments": "section.comments div.comments div#comments ol.commentlist div.comment ul.comment-list div#disqus_thread div.responses section#reader-comments div.reviews".split(),
    "share": "div.share div.social ul.share-links div.share-buttons div.author-box div.byline-links".split(),
}


def _open(place: str) -> tuple[str, str]:
    tag, kind, name = re.match(r"(\w+)([.#]?)(.*)", place).groups()
    return ("<%s%s>" % (tag, f' {"class" if kind == "." else "id"}="{name}"' if kind else ""), f"</{tag}>") if tag != "body" else ("", "")


def made_page(rng: np.random.Generator, words: list[str]) -> list[tuple[tuple[str, str], bool]]:
    """A page laid out at random: pieces of html, each with whether its text is main text."""

    def some(least: int, most: int) -> str:
        at, n = int(rng.integers(len(words))), int(rng.integers(least, most))
        return html.escape(" ".join(words[at : at + n] or words[:n]), quote=False)

    def part(kind: str) -> list[tuple[str, bool]]:
        begin, end = _open(_PARTS[kind][rng.integers(len(_PARTS[kind]))])
        out = [(begin, False)]
        if kind in ("menu", "share", "sidebar") and rng.random() < 0.8:
            out += [("<ul>" + "".join(f'<li><a href="/x">{some(1, 4)}</a></li>' for _ in range(rng.integers(2, 9))) + "</ul>", False)]
        elif kind == "form":
            out += [(f"<label>{some(1, 4)}</label><input><button>{some(1, 3)}</button>", False)]
        else:
            for _ in range(rng.integers(1, 5 if kind == "comments" else 3)):
                text = some(2, 60 if kind in ("comments", "sidebar") else 25)
                out += [((f"<p>{text}</p>", f"<div>{text}</div>", text + "<hr>", f"<h3>{some(1, 4)}</h3><p>{text}</p>")[rng.integers(4)], False)]
        return [*out, (end, False)]

    def several(kinds: str, most: int) -> list[tuple[str, bool]]:
        names = kinds.split()
        return [x for _ in range(rng.integers(0, most + 1)) for x in part(names[rng.integers(len(names))])]

    begin, end = _open(_MAIN[rng.integers(len(_MAIN))])
    page = [("<body>", False), *several("menu header notice advert menu", 4), (begin, False)]
    if rng.random() < 0.3:
        page += [("<header>", False)] if rng.random() < 0.3 else []
        page += several("share advert", 1)
    page += [(f"<h1>{some(1, 12)}</h1>", True)] if rng.random() < 0.8 else []
    for _ in range(rng.integers(1, 14)):
        text = some(1, 90)
        kind = rng.random()
        if kind < 0.75:
            page += [((f"<p>{text}</p>", f"<p><b>{text}<br>", f"<p>{text}", f"<div>{text}</div>")[rng.choice(4, p=[0.6, 0.15, 0.15, 0.1])], True)]
        elif kind < 0.9:
            page += [((f"<h2>{some(1, 8)}</h2>", f"<blockquote>{text}</blockquote>", f"<pre>{text}</pre>", f"<ul><li>{some(2, 15)}</li><li>{some(2, 15)}</li></ul>", f"<table><tr><td>{some(1, 5)}</td><td>{some(1, 5)}</td></tr></table>")[rng.integers(5)], True)]
        else:
            page += several("advert sidebar notice form share", 1)
    page += several("comments share advert", 1) + [(end, False)] + several("comments sidebar footer form advert notice footer", 4)
    return page


def trained(pages: DataFrame, sampled: int = SAMPLED_PAGES, made: int = TRAINED_PAGES) -> Labeller:
    """Fitted on pages made of the words of at most ``sampled`` pages, those with the smallest hashes."""
    rows = pages.where("html IS NOT NULL").select(F.col("html").cast("string").alias("html")).orderBy(F.xxhash64("html"), "html").limit(sampled)
    words = [w for r in rows.collect() for _, text, _ in blocks(r["html"]) for w in text.split()[:2000]] or ["word"]
    rng = np.random.default_rng(9)
    features, labels = [], []
    for _ in range(made):
        laid = made_page(rng, words)
        marked = "".join(re.sub(r">([^<]+)", lambda m: f">\ue000{m[1]}" if main else m[0], f">{piece}")[1:] for piece, main in laid)
        read = blocks(marked)
        if read:
            labels.append(np.array(["\ue000" in text for _, text, _ in read], dtype=np.float32))
            features.append(vectors([(p, t.replace("\ue000", ""), s) for p, t, s in read]))
    model = Labeller()
    model.train(features, labels)
    return model


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    labeller = pages.sparkSession.sparkContext.broadcast(model or trained(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(a, PAGES_AT_ONCE)
                read = [blocks(page or "") for page in batch.column(2).to_pylist()]
                texts = [""] * len(read)
                # Pages of like length together, so that one long page makes no others long.
                order = sorted((i for i, r in enumerate(read) if r), key=lambda i: len(read[i]))
                for b in range(0, len(order), 16):
                    some = order[b : b + 16]
                    for i, chances in zip(some, labeller.value.chances([vectors(read[i]) for i in some])):
                        texts[i] = " ".join(text for (_, text, _), p in zip(read[i], chances) if p >= 0.5)
                counts = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"])

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")
