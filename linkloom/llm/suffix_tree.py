"""Language-model scores from a probabilistic suffix tree over running letters.

A text is its lower-cased words with one space between them, between two ends.
From the training texts every context of up to ``DEPTH`` letters, spaces
included, gets a next-letter distribution.  A context stays in the tree only if
its distribution diverges enough from that of its longest proper suffix; what
stays is smoothed towards that suffix.  The score of a text multiplies the
probabilities of all its letters, and of its end, each in the longest suffix
state: words that training never saw are scored like all others, and what
stands before a word counts.

A gram is a full context and the letter after it, as the bytes of one integer.
Grams are gathered in slices of texts, counted by their owners, given their
logarithms level by level in joins, and sent back to their slices.  The tree is
a table of any size: nothing of it is broadcast or collected.

The base score is the unigram score of words, add-one smoothed, with one symbol
for all words unseen in training.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.words import held_out, staged, text_bytes
from linkloom.session import drop_stage

DEPTH = 5
# Divergence times count, in nats, below which a context adds nothing to its suffix.
LEAST_GAIN = 60.0
# Pseudo-counts that pull a state's distribution towards its suffix.
SMOOTHING = 4.0
# Most frequent words whose counts every task holds; all others meet their counts in a join.
FREQUENT_WORDS = 60_000
# Words a task counts before it passes them on.
COUNTED_WORDS = 400_000
# Texts a task scores at once.
SCORED_TEXTS = 250
# Letters whose grams are gathered at once; longer texts are cut.
SLICE_LETTERS = 8_000_000
ALPHABET = 257
# The end of a text as a word; a word cannot hold a space.
END = b" "
# The end of a text as a letter; a word cannot hold a line break either.
BREAK = b"\n"

def word_counts(docs: DataFrame) -> DataFrame:
    """``word binary, c long`` over the whole texts of ``docs``; the end of a text counts as the word ``END``."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"]
            )

        for frame in frames:
            texts = frame.column(0).to_pylist()
            held[END] += len(texts)
            for text in texts:
                held.update(text.lower().split())
                if len(held) > COUNTED_WORDS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return docs.select(text_bytes()).mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _slices(frame: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (frame.slice(low, SCORED_TEXTS) for low in range(0, frame.num_rows, SCORED_TEXTS))


State = tuple[bytes, dict[int, int]]


class SuffixTree:
    """The model in plain form, of few states: what :func:`gram_logs` computes in joins."""

    def __init__(self, states: list[State]) -> None:
        self.seen: dict[bytes, dict[int, float]] = {}
        self.left: dict[bytes, float] = {}
        for context, counts in sorted(states, key=lambda s: (len(s[0]), s[0])):
            total = sum(counts.values())
            weight = SMOOTHING * len(counts)
            base = [self.probability(context[1:], symbol) if context else 1.0 / ALPHABET for symbol in counts]
            self.seen[context] = {
                symbol: (n + weight * p) / (total + weight) for (symbol, n), p in zip(counts.items(), base, strict=True)
            }
            self.left[context] = weight / (total + weight)

    def probability(self, context: bytes, symbol: int) -> float:
        """Of ``symbol`` in the longest suffix state of ``context``."""
        scale = 1.0
        for low in range(len(context) + 1):
            state = self.seen.get(context[low:])
            if state is not None:
                p = state.get(symbol)
                if p is not None:
                    return scale * p
                scale *= self.left[context[low:]]
        return scale / ALPHABET

    def word_log10(self, word: bytes) -> float:
        """The log10 probability of a word's letters and its end."""
        padded = b"\x00" + word + b"\x00"
        return sum(
            math.log10(self.probability(padded[max(0, at - DEPTH) : at], padded[at])) for at in range(1, len(padded))
        )


def _codes(letters: bytes, sizes: np.ndarray) -> np.ndarray:
    """The grams of pieces that lie behind each other; the first ``DEPTH`` letters of each are context alone."""
    values = np.frombuffer(letters, np.uint8)
    code = values.astype(np.int64)
    for depth in range(1, DEPTH + 1):
        code[depth:] += values[:-depth].astype(np.int64) << (8 * depth)
    scored = np.ones(len(code), bool)
    starts = np.cumsum(sizes) - sizes
    for depth in range(DEPTH):
        scored[starts + depth] = False
    return code[scored]


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text between two ends, cut where it is long; every piece begins with the ``DEPTH`` letters before it."""
    data = BREAK * DEPTH + text + BREAK
    for low in range(DEPTH, len(data), SLICE_LETTERS):
        yield data[low - DEPTH : low + SLICE_LETTERS]


def _dealt(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct grams: their order by owner, the owners, and where each begins in that order."""
    owner = grams % buckets
    order = np.argsort(owner, kind="stable")
    owners, starts = np.unique(owner[order], return_index=True)
    return order, owners, starts


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _read(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def _read_grams(packed: bytes) -> np.ndarray:
    """Ascending grams are sent as their differences."""
    return np.cumsum(_read(packed, np.int64))


def _unpacked(sizes: bytes, letters: bytes) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.frombuffer(sizes, np.int64)
    return lengths, _codes(zstandard.ZstdDecompressor().decompress(letters), lengths)


def _gathered(buckets: int):
    """The distinct grams of every slice and how often they are in its training texts, packed for each owner."""
    kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary())

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for name, sizes, held, letters in zip(*frame.columns, strict=True):
                lengths, codes = _unpacked(sizes.as_py(), letters.as_py())
                train = np.repeat(~np.frombuffer(held.as_py(), bool), lengths - DEPTH)
                grams = np.unique(codes)
                trained, n = np.unique(codes[train], return_counts=True)
                counts = np.zeros(len(grams), np.int32)
                counts[np.searchsorted(grams, trained)] = n
                order, owners, starts = _dealt(grams, buckets)
                parts = (np.split(x[order], starts[1:]) for x in (grams, counts))
                out = [
                    (int(o), name.as_py(), _packed(np.diff(g, prepend=0)), _packed(c)) for o, g, c in zip(owners, *parts, strict=True)
                ]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "slice", "grams", "counts"])

    return run


def _counted(sent: pd.DataFrame) -> pd.DataFrame:
    """For one owner: every gram once, with its count in all training texts."""
    grams, inverse = np.unique(np.concatenate([_read_grams(x) for x in sent["grams"]]), return_inverse=True)
    counts = np.concatenate([_read(x, np.int32) for x in sent["counts"]])
    return pd.DataFrame({"gram": grams, "n": np.bincount(inverse, counts, len(grams)).astype(np.int64)})


def _answered(sent: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """For one owner: the logarithms of every slice's grams, in the order in which they were sent, in single precision."""
    order = np.argsort(known["gram"].to_numpy())
    grams, logs = known["gram"].to_numpy()[order], known["log"].to_numpy()[order].astype(np.float32)
    found = [_packed(logs[np.searchsorted(grams, _read_grams(x))]) for x in sent["grams"]]
    return pd.DataFrame({"slice": sent["slice"], "bucket": sent["bucket"], "logs": found})


def _summed(buckets: int):
    """For one slice: the sum of logarithms of each of its pieces."""

    def run(pieces: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        lengths, codes = _unpacked(pieces["sizes"].iloc[0], pieces["letters"].iloc[0])
        order = np.argsort(codes)
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        by_owner, _, _ = _dealt(codes[first], buckets)
        logs = np.empty(len(first))
        logs[by_owner] = np.concatenate([_read(x, np.float32) for x in answers.sort_values("bucket")["logs"]])
        each = np.empty(len(codes))
        each[order] = np.repeat(logs, np.diff(first, append=len(codes)))
        starts = np.cumsum(lengths - DEPTH) - (lengths - DEPTH)
        return pd.DataFrame({"row": np.frombuffer(pieces["rows"].iloc[0], np.int64), "score": np.add.reduceat(each, starts)})

    return run


def gram_logs(grams: DataFrame) -> DataFrame:
    """``gram, log``: log10 of the last letter's probability in the longest retained suffix of its context.

    ``grams`` are ``gram, n``, each once; an ``n`` of zero asks for a gram that
    training did not see.  The gain of a context is the sum over its next letters
    of ``n * ln(p(letter | context) / p(letter | suffix))``; all contexts of
    ``LEAST_GAIN`` stay, and so does the empty one.  A context has 256 next
    letters at most and is the suffix of 256 at most, so no key is hot.
    """
    levels = [grams.select("gram", "n")]
    for depth in reversed(range(DEPTH)):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1)).alias("gram")
        levels.append(levels[-1].groupBy(shorter).agg(F.sum("n").alias("n")))
    levels.reverse()
    same = Window.partitionBy(F.shiftright("gram", 8))
    weight = F.lit(SMOOTHING) * F.sum(F.expr("int(n > 0)")).over(same)
    total = F.sum("n").over(same)
    smoothed = (F.col("n") + F.col("weight") * F.col("p")) / (F.col("total") + F.col("weight"))
    root = levels[0].select("gram", "n", total.alias("total"), weight.alias("weight"), F.lit(1 / ALPHABET).alias("p"))
    model = root.withColumn("p", F.when(F.col("total") > 0, smoothed).otherwise(F.col("p")))
    for depth in range(1, DEPTH + 1):
        suffix = model.select(
            F.col("gram").alias("suffix"), F.col("n").alias("suffix_n"), F.col("total").alias("suffix_total"), "p"
        )
        lower = F.col("gram").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        there = levels[depth].withColumn("suffix", lower).join(suffix, "suffix")
        part = F.when(F.col("n") > 0, F.col("n") * F.log(F.col("n") * F.col("suffix_total") / F.col("suffix_n"))).otherwise(0.0)
        model = there.select(
            "gram", "n", total.alias("total"), weight.alias("weight"), F.sum(part).over(same).alias("parts"), "p"
        )
        gain = F.col("parts") - F.col("total") * F.log("total")
        kept = (F.col("total") > 0) & (gain >= LEAST_GAIN)
        model = model.withColumn("p", F.when(kept, smoothed).otherwise(F.col("p")))
    return model.select("gram", F.log10("p").alias("log"))


def text_scores(slices: DataFrame) -> DataFrame:
    """``row, score`` of all texts in ``slice, rows, sizes, held, letters``."""
    buckets = 4 * int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    schema = "bucket int, slice string, grams binary, counts binary"
    sent = staged(slices.select("slice", "sizes", "held", "letters").mapInArrow(_gathered(buckets), schema), "grams")
    counted = staged(sent.groupBy("bucket").applyInPandas(_counted, "gram long, n long"), "gram-counts")
    logs = staged(gram_logs(counted), "gram-logs")
    drop_stage(counted)
    owned = logs.withColumn("bucket", (F.col("gram") % F.lit(buckets)).cast("int"))
    answers = (
        sent.select("bucket", "slice", "grams")
        .groupBy("bucket")
        .cogroup(owned.groupBy("bucket"))
        .applyInPandas(_answered, "slice string, bucket int, logs binary")
    )
    answers = staged(answers, "answers")
    drop_stage(sent)
    drop_stage(logs)
    asked = slices.select("slice", "rows", "sizes", "letters").groupBy("slice")
    sums = asked.cogroup(answers.groupBy("slice")).applyInPandas(_summed(buckets), "row long, score double")
    return sums.groupBy("row").agg(F.sum("score").alias("score"))


def suffix_tree_scores(docs: DataFrame, folds: int = 7) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the documents not held out.  A null text is empty: its only token
    is the end.  Scores are log10 probabilities of whole texts.  Repeated rows give
    a row each; a null id is held out.  Without training texts nothing is known
    and the tree is uniform.
    """
    spark = docs.sparkSession
    words = staged(word_counts(docs.where(~held_out("doc_id", folds))), "words")
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = int(sums["n"]), int(sums["v"])
    unseen_base = math.log10(1 / (tokens + distinct + 1))
    known = words.select("word", F.log10((F.col("c") + 1) / F.lit(tokens + distinct + 1)).alias("base"), "c")
    frequent = known.orderBy(F.desc("c"), "word").limit(FREQUENT_WORDS).collect()
    places = {bytes(r["word"]): place for place, r in enumerate(frequent)}
    # The last entry stands for words that are not among the frequent ones.
    bases = np.array([r["base"] for r in frequent] + [0.0])
    shared = spark.sparkContext.broadcast((places, bases))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", folds).alias("held"),
        text_bytes().alias("text"),
    )
    # Three kinds of rows: one for each text, one for each of its words that are not frequent, and slices.
    schema = """row long, doc_id long, word binary, times int, tokens long, known long, base double,
        slice string, rows binary, sizes binary, held binary, letters binary"""
    names = "row doc_id word times tokens known base slice rows sizes held letters".split()
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.string(), *[pa.binary()] * 4)
    empty = (None,) * 5

    def batch(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, bases = shared.value
        other = len(bases) - 1
        held: list[tuple[int, bool, bytes]] = []
        count = part = 0

        def flush() -> pa.RecordBatch:
            numbers, outs, pieces = zip(*held, strict=True)
            packed = zstandard.ZstdCompressor(level=1).compress(b"".join(pieces))
            sizes = np.array([len(x) for x in pieces], np.int64)
            arrays = (np.array(numbers, np.int64), sizes, np.array(outs, bool))
            return batch([(*[None] * 7, f"{numbers[0]}-{part}", *(x.tobytes() for x in arrays), packed)])

        for frame in (part for whole in frames for part in _slices(whole)):
            out: list[tuple] = []
            for row, doc, outside, text in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                found = text.lower().split()
                for piece in _pieces(b" ".join(found)):
                    held.append((row, outside, piece))
                    count += len(piece)
                    if count >= SLICE_LETTERS:
                        yield flush()
                        held, count, part = [], 0, part + 1
                found.append(END)
                at = np.fromiter((places.get(word, other) for word in found), np.int32, len(found))
                unknown = np.flatnonzero(at == other)
                out.append((row, doc, None, None, len(found), len(found) - len(unknown), float(bases[at].sum()), *empty))
                for word, times in Counter([found[i] for i in unknown]).items():
                    out.append((row, None, word, times, None, None, None, *empty))
            yield batch(out)
        if held:
            yield flush()

    parts = staged(rows.mapInArrow(score, schema), "word-scores")
    rare = (
        parts.where("word IS NOT NULL")
        .select("row", "word", "times")
        .join(known.drop("c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("base").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.coalesce("base", F.lit(unseen_base))).alias("rare_base"),
        )
    )
    rare = staged(rare, "rare-words")
    scores = staged(text_scores(parts.where("slice IS NOT NULL")), "scores")
    whole = parts.where("tokens IS NOT NULL").select("row", "doc_id", "tokens", "known", "base")
    return whole.join(rare, "row", "left").join(scores, "row", "left").select(
        "doc_id",
        held_out("doc_id", folds).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
