"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks in page order.  A bidirectional LSTM reads for
each block the tags and names on its path, its hashed words and its size, and
labels every block from the context of the whole page.  It is trained on pages
whose mark-up tells content from the rest, with the mark-up varied: containers
renamed, boilerplate of other kinds put in.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import WordCache, batches

# The sample the labeller is fitted on: pages with the smallest hashes of their ids, none longer than that.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 30_000
PATH_WIDTH = 160
WORD_WIDTH = 32
EXTRA = 4
WIDTH = PATH_WIDTH + WORD_WIDTH + EXTRA
HIDDEN = 16
EPOCHS = 14

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[^a-z]+")
# Elements that do not break a line, and elements without an end.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Names that tell boilerplate.
OTHER = (
    "nav aside header footer form menu sidebar ad ads advert advertisement promo sponsor banner cookie notice consent comment"
    " comments discussion respond reply share social related newsletter breadcrumb pagination login search widget"
    " head title select button label fieldset dialog"
).split()


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int = 0


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page with the names on their paths; references decoded, white space made one space."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            found.append(Block(tuple(name for _, names in stack for name in names), text, linked))
        pieces.clear()
        linked = 0

    for token in TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            decoded = html.unescape(text)
            pieces.append(decoded)
            if any(tag == "a" for tag, _ in stack[-3:]):
                linked += len(decoded)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
            continue
        block = tag not in INLINE
        if block:
            flush()
        if token["end"]:
            if any(tag == open_tag for open_tag, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            if block and tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option", *HEADINGS):
                _close_implied(stack, tag)
            elif block:
                _close_implied(stack, "p")
            stack.append((tag, _names(tag, token["attributes"]) if block else ()))
    flush()
    return found


def _close_implied(stack: list[tuple[str, tuple[str, ...]]], tag: str) -> None:
    """An open paragraph ends where a block begins, and a list item or cell where the next of its kind does."""
    for at in range(len(stack) - 1, -1, -1):
        name = stack[at][0]
        if name == "p" or name == tag:
            del stack[at:]
            return
        if name not in INLINE:
            return


@lru_cache(maxsize=10_000)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    names = [tag]
    for match in ATTRIBUTE.finditer(attributes):
        names += [n for n in NAME.split((match[1] or match[2] or match[3] or "").lower()) if n]
    return tuple(names)


def taught(blocks: list[Block]) -> np.ndarray:
    """Labels that the mark-up itself gives away."""
    other = set(OTHER)
    container = any("article" in b.path or "main" in b.path for b in blocks)
    out = []
    for block in blocks:
        inside = bool({"article", "main"} & set(block.path)) if container else True
        out.append(inside and not other & set(block.path[_container(block.path) :]))
    return np.array(out, np.float32)


def _container(path: tuple[str, ...]) -> int:
    return next((at for at, name in enumerate(path) if name in ("article", "main")), 0)


class Features:
    """Block features: a path's names and its last tag in hashed places, words in hashed bins, sizes."""

    def __init__(self) -> None:
        self.words: WordCache[int] = WordCache(lambda w: xxhash.xxh32_intdigest(w.encode()) % WORD_WIDTH)
        self.paths: WordCache[np.ndarray] = WordCache(self._path, 20_000)

    @staticmethod
    def _path(path: tuple[str, ...]) -> np.ndarray:
        out = np.zeros(PATH_WIDTH, np.float32)
        for name in path:
            out[xxhash.xxh32_intdigest(name, 1) % (PATH_WIDTH - 32)] = 1.0
        if path:
            out[PATH_WIDTH - 32 + xxhash.xxh32_intdigest(path[-1], 2) % 32] = 1.0
        return out

    def of(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), WIDTH), np.float32)
        for row, block in zip(out, blocks, strict=True):
            row[:PATH_WIDTH] = self.paths[block.path]
            bins = list(map(self.words.__getitem__, block.text.split()))
            row[PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] = np.bincount(bins, minlength=WORD_WIDTH) / max(1, len(bins))
            size = len(block.text)
            row[-EXTRA:] = (np.log1p(size) / 8, min(1.0, block.linked / max(1, size)), block.text[-1] in ".!?", 1.0)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """A bidirectional LSTM and a logistic output, in numpy."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.weights = {}
        for side in ("f", "b"):
            self.weights[side + "x"] = rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)).astype(np.float32)
            self.weights[side + "h"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.weights[side + "c"] = np.zeros(4 * HIDDEN, np.float32)
            self.weights[side + "c"][HIDDEN : 2 * HIDDEN] = 1.0
        self.weights["o"] = rng.normal(0, 0.15, 2 * HIDDEN).astype(np.float32)
        self.weights["oc"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, tape: list | None) -> np.ndarray:
        """States of one direction over ``x[page, block, feature]``; blocks beyond a page's end change nothing."""
        gates_in = x @ self.weights[side + "x"] + self.weights[side + "c"]
        recurrent = self.weights[side + "h"]
        h = np.zeros((len(x), HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((*x.shape[:2], HIDDEN), np.float32)
        steps = range(x.shape[1]) if side == "f" else range(x.shape[1] - 1, -1, -1)
        for t in steps:
            z = gates_in[:, t] + h @ recurrent
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new_c = f * c + i * g
            if tape is not None:
                tape.append((t, h, c, i, f, o, g, new_c, m))
            c = m * new_c + (1 - m) * c
            h = m * o * np.tanh(new_c) + (1 - m) * h
            out[:, t] = h
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._run(x, mask, side, None) for side in ("f", "b")], axis=2)
        return _sigmoid(states @ self.weights["o"] + self.weights["oc"][0])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        tapes: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._run(x, mask, side, tapes[side]) for side in ("f", "b")], axis=2)
        p = _sigmoid(states @ self.weights["o"] + self.weights["oc"][0])
        total = max(1.0, mask.sum())
        loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
        d = mask * (p - y) / total
        grads = {"o": np.einsum("nt,nth->h", d, states), "oc": np.array([d.sum()], np.float32)}
        d_states = d[:, :, None] * self.weights["o"]
        for at, side in enumerate(("f", "b")):
            d_out = d_states[:, :, at * HIDDEN : (at + 1) * HIDDEN]
            recurrent = self.weights[side + "h"]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            d_recurrent = np.zeros_like(recurrent)
            dh = np.zeros((len(x), HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, g, new_c, m in reversed(tapes[side]):
                dh = dh + d_out[:, t]
                tanh_c = np.tanh(new_c)
                d_new = m * (dc + dh * o * (1 - tanh_c**2))
                dz = np.concatenate(
                    [d_new * g * i * (1 - i), d_new * c * f * (1 - f), m * dh * tanh_c * o * (1 - o), d_new * i * (1 - g**2)], axis=1
                )
                dz_all[:, t] = dz
                d_recurrent += h.T @ dz
                dh = dz @ recurrent.T + (1 - m) * dh
                dc = d_new * f + (1 - m) * dc
            grads[side + "h"] = d_recurrent
            grads[side + "x"] = np.einsum("ntd,ntk->dk", x, dz_all, optimize=True)
            grads[side + "c"] = dz_all.sum(axis=(0, 1))
        return loss, grads


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, WIDTH), np.float32)
    mask = np.zeros((len(sequences), longest), np.float32)
    for row, sequence in enumerate(sequences):
        x[row, : len(sequence)] = sequence
        mask[row, : len(sequence)] = 1.0
    return x, mask


# Boilerplate put into training pages, as paths below the body, and containers that content may have.
INSERTED = (
    "div sidebar,p|aside,p|aside,ul,li|section comments,div comment,p|div comments,p|div id comment list,li|form,label|form,p|"
    "div cookie notice,p|div notice,p|div banner,p|div ad,p|div advert,p|div sponsor,p|header,p|header,h1|header,div|"
    "footer,p|footer,div|footer,ul,li|nav,a|nav,ul,li|div menu,ul,li|div related,ul,li|div share,ul,li|div social,p|"
    "div newsletter,p|div breadcrumb,p|div login,form,label|div pagination,p|div promo,p|button|select,option|ol comments,li|"
    "section discussion,p|div respond,form,p|div widget,p|div consent,p"
)
CONTAINERS = "article|main|main,article|div content,article|div post|div entry content|div article body|section story|div main content|div content"


def varied(blocks: list[Block], labels: np.ndarray, texts: list[str], rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """A page with its container renamed and other boilerplate put in."""
    container = tuple(n for part in rng.choice(CONTAINERS.split("|")).split(",") for n in part.split())
    out, marks = [], []

    def insert(within: bool) -> None:
        path = tuple(n for part in rng.choice(INSERTED.split("|")).split(",") for n in part.split())
        for _ in range(rng.choice((1, 1, 2, 4))):
            text = rng.choice(texts)
            words = text.split()
            cut = " ".join(words[: rng.choice((2, 5, 12, 60))])
            out.append(Block(("html", "body", *(container if within else ()), *path), cut, len(cut) if path[-1] in ("a", "li") else 0))
            marks.append(0.0)

    for block, label in zip(blocks, labels, strict=True):
        path = block.path
        if label:
            tail = tuple(n for n in path[_container(path) :] if n not in ("article", "main", "html", "body"))
            tail = rng.choice((tail, tail, (*tail[:-1], "li"), (*tail[:-1], "blockquote", "p"))) if tail and tail[-1] == "p" else tail
            path = ("html", "body", *container, *tail)
        if rng.random() < 0.08:
            insert(bool(label) and rng.random() < 0.5)
        out.append(Block(path, block.text, block.linked))
        marks.append(float(label))
    for _ in range(rng.choice((0, 1, 2))):
        insert(False)
    return out, np.array(marks, np.float32)


def train(pages: list[str], seed: int = 5) -> BlockLabeller:
    """Fit the labeller to pages as they are and varied."""
    rng = random.Random(seed)
    features = Features()
    parsed = [b for b in map(blocks_of, pages) if b]
    labeller = BlockLabeller(seed)
    if not parsed:
        return labeller
    texts = [block.text for blocks in parsed for block in blocks][:5_000]
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in labeller.weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        examples = []
        for blocks in parsed:
            labels = taught(blocks)
            if epoch % 2 or rng.random() < 0.5:
                blocks, labels = varied(blocks, labels, texts, rng)
            examples.append((features.of(blocks), labels))
        examples.sort(key=lambda e: len(e[0]))
        groups = list(batches(examples, 16))
        rng.shuffle(groups)
        for group in groups:
            x, mask = padded([e[0] for e in group])
            y = np.zeros(mask.shape, np.float32)
            for row, (_, labels) in enumerate(group):
                y[row, : len(labels)] = labels
            _, grads = labeller.gradients(x, mask, y)
            step += 1
            rate = 0.02 * min(1.0, 1.5 - epoch / EPOCHS)
            for key, grad in grads.items():
                first, second = moments[key]
                grad = np.clip(grad, -1, 1)
                first += 0.1 * (grad - first)
                second += 0.01 * (grad**2 - second)
                labeller.weights[key] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return labeller


def sample_pages(pages: DataFrame) -> list[str]:
    """At most ``SAMPLE_PAGES`` pages, those with the smallest hashes of their ids."""
    fit = pages.where(F.col("html").isNotNull() & (F.length("html") <= SAMPLE_CHARS) & F.col("page_id").isNotNull())
    rows = fit.select(F.xxhash64("page_id").alias("place"), "page_id", "html").orderBy("place", "page_id", "html").limit(SAMPLE_PAGES)
    return [r["html"] for r in rows.collect()]


def _extract(labeller: BlockLabeller):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for frame in frames:
            texts: list[str] = []
            for some in batches(frame.column("html").to_pylist(), 500):
                parsed = [blocks_of(page or "") for page in some]
                found = [""] * len(some)
                order = sorted((i for i, b in enumerate(parsed) if b), key=lambda i: len(parsed[i]))
                for group in batches(order, 50):
                    p = labeller.probabilities(*padded([features.of(parsed[i]) for i in group]))
                    for row, i in enumerate(group):
                        found[i] = " ".join(b.text for b, x in zip(parsed[i], p[row], strict=False) if x > 0.5)
                texts += found
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [frame.column("page_id"), frame.column("url"), pa.array(texts, pa.string()), sizes],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def main_text(pages: DataFrame, labeller: BlockLabeller | None = None) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    A null or blank page has the empty text.  Repeated rows give a row each; null
    ids and urls stay null.  Other columns are not read.
    """
    fitted = labeller or train(sample_pages(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extract(fitted), "page_id long, url string, text string, n_chars long")
