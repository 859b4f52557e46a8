"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel of two words counts the four-letter subsequences they share, each
weighted by ``DECAY`` to the length it spans, so ``id-iot`` and ``idixot`` stay
close to ``idiot``.  A document is a bag of words: it is toxic if one of them
is, so the machine is trained on the most telling word of every labelled toxic
sentence against the words of clean ones (multiple-instance learning).
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import CACHED_WORDS, WordCache, batches, held_out, portions

DECAY = 0.65
# Offsets of a subsequence's later letters; at most two letters are skipped.
STEPS = tuple(
    (a, b, c) for a in range(1, 4) for b in range(a + 1, 5) for c in range(b + 1, 6)
)
WEIGHTS = tuple(DECAY ** (last + 1) for _, _, last in STEPS)
# The sample the machine is fitted on: so many labelled documents of each class, none longer than that.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 12_000
LANDMARKS = 320
ROUNDS = 3
# Log odds from which a piece of a word makes the word a first witness.
TELLING = 3.5
THRESHOLD = 0.3
BIAS = -1.0
# What a text without words counts as.
NO_WORDS = -1.5

SPELLED_OUT = re.compile(r"(?<!\S)\w(?:[ \t]+\w(?!\S)){2,}")
EDGES = string.punctuation + "…“”„«»¡¿"
LONGEST = 64
FILTER = 1 << 20


def words_of(text: str) -> set[str]:
    """Distinct lower-cased words; letters spelled out one by one also count as the word they make.

    Strings of more than ``LONGEST`` characters count as overlapping pieces.
    """
    lower = text.lower()
    words = set(lower.split())
    for run in SPELLED_OUT.findall(lower):
        words.add("".join(run.split()))
    endless = [word for word in words if len(word) > LONGEST]
    words.difference_update(endless)
    for word in endless:
        words.update(word[at : at + LONGEST] for at in range(0, len(word), LONGEST // 2))
    return words


def marked(word: str) -> str:
    """A word without the punctuation around it, its ends marked."""
    return f"^{word.strip(EDGES)[:LONGEST]}$"


# The norm of a word of each length, all its subsequences taken as different.
NORMS = np.sqrt(
    [1e-9 + sum(max(0, n - steps[2]) * w * w for steps, w in zip(STEPS, WEIGHTS, strict=True)) for n in range(LONGEST + 3)]
)


def subsequences(word: str) -> dict[str, float]:
    """The normalised feature vector of a word."""
    bare = marked(word)
    found: dict[str, float] = {}
    size = len(bare)
    for (a, b, c), weight in zip(STEPS, WEIGHTS, strict=True):
        for i in range(size - c):
            key = bare[i] + bare[i + a] + bare[i + b] + bare[i + c]
            found[key] = found.get(key, 0.0) + weight
    norm = NORMS[size]
    return {key: x / norm for key, x in found.items()}


@dataclass(frozen=True)
class ToxicityModel:
    """The landmarks' expansion folded into one weight for each subsequence, and the score's calibration."""

    weights: dict[str, float]
    bias: float
    slope: float
    offset: float

    def margin(self, word: str) -> float:
        weights = self.weights
        return self.bias + sum(x * weights[key] for key, x in subsequences(word).items() if key in weights)

    def probability(self, margin: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * margin + self.offset))))


def _telling(bags: list[set[str]], labels: np.ndarray) -> dict[str, float]:
    """How much more often toxic documents hold a piece of a word: log odds of pieces of 4 to 6 letters."""
    words = {True: Counter(), False: Counter()}
    for bag, label in zip(bags, labels, strict=True):
        words[bool(label)].update(bag)
    pieces = {True: Counter(), False: Counter()}
    for label, counts in words.items():
        for word, n in counts.items():
            for piece in set(_pieces(word)):
                pieces[label][piece] += n
    n_toxic, n_clean = max(1, int(labels.sum())), max(1, int((~labels).sum()))
    least = max(2, n_toxic // 500)
    clean = pieces[False]
    return {
        piece: math.log((n + 0.5) / (n_toxic + 1)) - math.log((clean[piece] + 0.5) / (n_clean + 1))
        for piece, n in pieces[True].items()
        if n >= least
    }


def _pieces(word: str) -> Iterable[str]:
    bare = marked(word)
    return (bare[i : i + n] for n in (4, 5, 6) for i in range(len(bare) - n + 1))


def _variants(word: str, rng: random.Random) -> list[str]:
    """The word with a letter inserted and with separators."""
    if len(word) < 4:
        return [word]
    at = rng.randrange(1, len(word))
    return [word, word[:at] + rng.choice("-.*_xz1") + word[at:], rng.choice("-.*_").join(word)]


class _Kernel:
    """Kernel values of words against landmarks."""

    def __init__(self, landmarks: list[str]) -> None:
        vectors = [subsequences(word) for word in landmarks]
        self.columns = {key: i for i, key in enumerate(dict.fromkeys(k for v in vectors for k in v))}
        self.matrix = np.zeros((len(landmarks), len(self.columns)))
        for row, vector in enumerate(vectors):
            for key, value in vector.items():
                self.matrix[row, self.columns[key]] = value

    def against(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.matrix)), np.float32)
        for row, word in enumerate(words):
            pairs = [(self.columns[k], v) for k, v in subsequences(word).items() if k in self.columns]
            if pairs:
                at, values = zip(*pairs, strict=True)
                out[row] = self.matrix[:, at] @ np.array(values)
        return out

    def whitening(self) -> np.ndarray:
        values, vectors = np.linalg.eigh(self.matrix @ self.matrix.T)
        kept = values > 1e-6
        return vectors[:, kept] / np.sqrt(values[kept])


def _support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Squared hinge loss with a ridge, by accelerated gradient steps.

    The bias is fixed at ``BIAS``: a word that shares nothing with any landmark
    is clean.
    """
    x, y = x.astype(np.float32), y.astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)
    scale = 2 * float(np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2) + ridge
    w = look = np.zeros(x.shape[1], np.float32)
    for step in range(150):
        slack = np.maximum(0.0, 1 - y * (x @ look + BIAS))
        gradient = -2 * x.T @ (weight * y * slack) + ridge * look
        new = look - gradient / scale
        look = new + step / (step + 3) * (new - w)
        w = new
    return w


def _logistic(margins: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities at the labels' true share."""
    weight = np.where(labels, prior / max(1, labels.sum()), (1 - prior) / max(1, (~labels).sum()))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -60, 60)))
        g = np.array([(weight * (p - labels) * margins).sum() + 1e-3 * slope, (weight * (p - labels)).sum()])
        curve = weight * p * (1 - p)
        h = np.array([[(curve * margins**2).sum() + 1e-3, (curve * margins).sum()], [(curve * margins).sum(), curve.sum() + 1e-9]])
        step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        slope, offset = slope - step[0], offset - step[1]
    return max(slope, 1e-3), float(offset)


def train(texts: list[str], toxic: list[bool], prior: float, seed: int = 7) -> ToxicityModel:
    """Fit the machine to labelled texts; ``prior`` is the share of toxic ones among all labelled documents."""
    labels = np.array(toxic, bool)
    bags = [words_of(text) for text in texts]
    if not labels.any() or labels.all():
        return ToxicityModel({}, 1.0 if len(labels) and labels.all() else -1.0, 4.0, 0.0)
    rng = random.Random(seed)
    odds = _telling(bags, labels)
    told = WordCache(lambda word: max((odds.get(p, -9.0) for p in _pieces(word)), default=-9.0), 10**9)
    clean_words = Counter(word for bag, label in zip(bags, labels, strict=True) if not label for word in bag)
    negatives = [w for w, _ in clean_words.most_common(3_000)]
    rest = sorted(set(clean_words) - set(negatives))
    negatives += rng.sample(rest, min(len(rest), 6_000))
    toxic_words = Counter(word for bag, label in zip(bags, labels, strict=True) if label for word in bag)
    share = (~labels).sum() / labels.sum()

    def rarely_clean(word: str) -> bool:
        return toxic_words[word] * share > 3 * clean_words[word]

    everything = {word for bag in bags for word in bag}
    hard: list[str] = []
    score = told.__getitem__
    model = ToxicityModel({}, -1.0, 1.0, 0.0)
    for turn in range(ROUNDS):
        witnesses: Counter[str] = Counter()
        for bag, label in zip(bags, labels, strict=True):
            if label and bag:
                telling = [w for w in bag if told[w] >= TELLING and rarely_clean(w) and (not turn or score(w) > -0.5)]
                witnesses.update(telling)
        if not witnesses:
            break
        positives = [w for w, _ in witnesses.most_common(4_000)]
        half = LANDMARKS // 2
        clean = [*hard[: half // 2], *negatives[: half // 4]]
        clean += rng.sample(negatives, min(len(negatives), half - len(clean)))
        landmarks = list(dict.fromkeys([*positives[:half], *clean]))
        kernel = _Kernel(landmarks)
        pairs = [(v, witnesses[w]) for w in positives for v in _variants(w, rng)]
        words = [w for w, _ in pairs] + negatives
        y = np.array([1.0] * len(pairs) + [-1.0] * len(negatives))
        counts = np.array([math.sqrt(n) for _, n in pairs] + [math.sqrt(clean_words[w]) for w in negatives])
        counts[: len(pairs)] *= counts[len(pairs) :].sum() / counts[: len(pairs)].sum() / 2
        whitening = kernel.whitening()
        w = _support_vectors(kernel.against(words) @ whitening, y, counts)
        expansion = whitening @ w @ kernel.matrix
        model = ToxicityModel(dict(zip(kernel.columns, expansion.tolist(), strict=True)), BIAS, 1.0, 0.0)
        margins = Margins(model)
        margins.learn(everything)
        score = margins.__getitem__
        tried = dict.fromkeys([*negatives, *rest])
        hard = sorted((w for w in tried if score(w) > -0.6), key=score, reverse=True)[:4_000]
        negatives = list(dict.fromkeys([*negatives, *hard]))
    bag_margins = np.array([max(map(score, bag), default=NO_WORDS) for bag in bags])
    slope, offset = _logistic(bag_margins, labels, prior)
    return ToxicityModel(model.weights, model.bias, slope, offset)


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int | None = 4) -> tuple[list[str], list[bool], float]:
    """Texts and labels of at most ``SAMPLE_DOCS`` documents of each class, and the share of toxic ones among all.

    The documents are those with the smallest hashes of their ids, so the sample
    spreads over the whole table.  With ``folds``, documents held out are left out.
    Documents with several labels are toxic if one of them says so.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    if folds:
        marked = marked.where(~held_out("doc_id", folds))
    sized = docs.where(f"text IS NOT NULL AND length(text) <= {SAMPLE_CHARS}")
    known = marked.join(sized.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id")
    shares = {int(r["toxic"] > 0): r["n"] for r in known.groupBy("toxic").count().withColumnRenamed("count", "n").collect()}
    if not shares:
        return [], [], 0.5
    chosen = []
    for label in shares:
        of_class = known.where(F.col("toxic") > 0 if label else F.col("toxic") <= 0)
        chosen += of_class.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).select("doc_id", "toxic").collect()
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int")
    rows = (
        sized.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(ids), "doc_id")
        .toPandas()
        .sort_values(["doc_id", "text"])
    )
    prior = shares.get(1, 0) / sum(shares.values())
    return rows["text"].tolist(), (rows["toxic"] > 0).tolist(), prior


class Margins(dict[str, float]):
    """Margins of words, those not seen before computed an array at a time."""

    def __init__(self, model: ToxicityModel) -> None:
        super().__init__()
        self.bias = model.bias
        keys = np.array([self._code(key) for key in model.weights], np.uint64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.weights = np.append(np.array(list(model.weights.values()), float)[order], 0.0)
        self.may = np.zeros(FILTER, bool)
        self.may[self._slot(keys)] = True

    @staticmethod
    def _code(key: str) -> int:
        return sum(min(ord(char), 0xFFFF) << (16 * (3 - i)) for i, char in enumerate(key))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def learn(self, words: Iterable[str]) -> None:
        new = [word for word in words if word not in self]
        if not new:
            return
        if self and len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = list(dict.fromkeys(words))
        bare = [marked(word) for word in new]
        sizes = np.fromiter(map(len, bare), np.int64, len(bare))
        letters = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.minimum(letters, 0xFFFF).astype(np.uint64)
        owner = np.repeat(np.arange(len(bare)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(letters))
        totals = np.zeros(len(bare))
        for (a, b, c), weight in zip(STEPS, WEIGHTS, strict=True):
            n = len(letters) - c
            if n <= 0:
                continue
            keys = letters[:n] << np.uint64(48) | letters[a : n + a] << np.uint64(32)
            keys |= letters[b : n + b] << np.uint64(16) | letters[c : n + c]
            at = np.flatnonzero(self.may[self._slot(keys)] & (left[:n] > c))
            place = np.searchsorted(self.keys, keys[at])
            hit = self.keys[place] == keys[at]
            totals += weight * np.bincount(owner[at[hit]], self.weights[place[hit]], len(bare))
        self.update(zip(new, (self.bias + totals / NORMS[sizes]).tolist(), strict=True))

    def of_texts(self, texts: list[str | None]) -> list[float]:
        """The largest margin among each text's words."""
        out: list[float] = []
        for some in batches(texts, 100):
            bags = [words_of(text or "") for text in some]
            self.learn(set().union(*bags))
            out += [max(map(self.__getitem__, bag), default=NO_WORDS) for bag in bags]
        return out


def _scorer(model: ToxicityModel):
    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(model)
        for frame in portions(frames, "text"):
            values = [model.probability(margin) for margin in margins.of_texts(frame.column(1).to_pylist())]
            scores = pa.array(values, pa.float64())
            flags = pa.array([int(v >= THRESHOLD) for v in values], pa.int32())
            yield pa.RecordBatch.from_arrays([frame.column(0), scores, flags], ["doc_id", "score", "predicted"])

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document: ``doc_id, score, predicted``.

    The score depends on the whole text alone; null and empty texts score as
    texts without a telling word.  Repeated rows give a row each, null ids stay
    null.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents of three folds of four, score all: ``doc_id, held_out, score, predicted``."""
    model = train(*labelled_sample(docs, labels))
    return score_toxicity(docs, model).select("doc_id", held_out("doc_id", 4).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those predicted toxic, all columns kept; the model sees text only."""
    model = train(*labelled_sample(docs, labels))

    def keep(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = Margins(model)
        for frame in portions(frames, "text"):
            found = margins.of_texts(frame.column("text").to_pylist())
            kept = [model.probability(margin) < THRESHOLD for margin in found]
            yield frame.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
