"""Benchmark decontamination by spaced seeds.

Fixed masks pick four of up to five neighbouring tokens and ignore the fifth.
Seeds of benchmark items are looked up among the seeds of every text; around
each hit the whole item is laid over the text at that offset and compared token
by token, so substituted words are tolerated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import fresh, hash_cache, hashes, portions, text_bytes

# Whatever five-token window has at most one substitution agrees under one of these masks,
# and of any passage that agrees in four fifths of its tokens some such window does.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
SIMILARITY = 0.8
# A window of this many tokens is enough, whatever the length of the item.
WINDOW = 13
LEAST_TOKENS = 5
# Benchmark text held by a task at once; a larger benchmark is taken in blocks.
BLOCK_BYTES = 8_000_000

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
FILTER_BITS = 22


def seeds(tokens: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The seed at each position under a mask."""
    size = len(tokens) - mask[-1]
    if size <= 0:
        return np.zeros(0, np.uint64)
    mixed = np.zeros(size, np.uint64)
    for offset, multiplier in zip(mask, MULTIPLIERS, strict=True):
        mixed += (tokens[offset : offset + size] ^ (tokens[offset : offset + size] >> np.uint64(29))) * multiplier
        mixed ^= mixed >> np.uint64(32)
    return mixed


class SeedIndex:
    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        cache = hash_cache()
        self.ids, self.tokens = [], []
        for item, text in items:
            tokens = hashes(text.lower().split(), cache)
            if len(tokens) >= LEAST_TOKENS:
                self.ids.append(item)
                self.tokens.append(tokens)
        self.masks = []
        for mask in MASKS:
            values = [seeds(t, mask) for t in self.tokens]
            key = np.concatenate([np.zeros(0, np.uint64), *values])
            item = np.repeat(np.arange(len(values)), [len(v) for v in values])
            place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(v)) for v in values)])
            order = np.argsort(key, kind="stable")
            may = np.zeros(1 << FILTER_BITS, bool)
            may[(key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.masks.append((mask, key[order], item[order], place[order], may))

    def alignments(self, tokens: np.ndarray) -> np.ndarray:
        """Distinct ``(offset of the item's first token, item)`` pairs with a seed in common."""
        found = []
        for mask, key, item, place, may in self.masks:
            here = seeds(tokens, mask)
            at = np.flatnonzero(may[(here >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(key, here[at], "left")
            count = np.searchsorted(key, here[at], "right") - low
            at, low, count = at[count > 0], low[count > 0], count[count > 0]
            rows = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            found.append(np.stack([np.repeat(at, count) - place[rows], item[rows]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def overlap(self, tokens: np.ndarray, offset: int, item: int) -> tuple[int, bool]:
        """Tokens that agree at this offset, and whether they are enough."""
        wanted = self.tokens[item]
        low, high = max(0, -offset), min(len(wanted), len(tokens) - offset)
        same = wanted[low:high] == tokens[offset + low : offset + high]
        total = int(same.sum())
        if total >= SIMILARITY * len(wanted):
            return total, True
        if len(same) < WINDOW:
            return total, False
        sums = np.cumsum(np.concatenate([[0], same]))
        return total, bool((sums[WINDOW:] - sums[:-WINDOW]).max() >= SIMILARITY * WINDOW)


def _search(index: SeedIndex):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = hash_cache()
        for frame in portions(frames, "text"):
            doc_ids, texts = frame.column(0).to_pylist(), frame.column(1).to_pylist()
            coded = [hashes(text.lower().split(), cache) for text in texts]
            starts = np.cumsum([0, *map(len, coded)])
            joined = np.concatenate([np.zeros(0, np.uint64), *coded])
            best: dict[tuple[int, int], int] = {}
            pairs = index.alignments(joined)
            # A seed names the text its item's own seed tokens lie in; the item's first token may lie before it.
            for doc, item, offset in _within(pairs, starts, index):
                total, enough = index.overlap(coded[doc], offset, item)
                if enough and total > best.get((doc, item), -1):
                    best[doc, item] = total
            rows = sorted(best.items())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[doc] for (doc, _), _ in rows], pa.int64()),
                    pa.array([index.ids[item] for (_, item), _ in rows], pa.int64()),
                    pa.array([len(index.tokens[item]) for (_, item), _ in rows], pa.int64()),
                    pa.array([total for _, total in rows], pa.int64()),
                ],
                ["doc_id", "item_id", "n_tokens", "n_agree"],
            )

    return run


def _within(pairs: np.ndarray, starts: np.ndarray, index: SeedIndex) -> Iterator[tuple[int, int, int]]:
    """Every text that an item laid at an offset of the joined texts touches, with the offset in that text."""
    for offset, item in pairs.tolist():
        first = max(0, int(np.searchsorted(starts, offset, "right")) - 1)
        end = offset + len(index.tokens[item])
        doc = first
        while doc < len(starts) - 1 and starts[doc] < end:
            if starts[doc + 1] > starts[doc]:
                yield doc, item, offset - int(starts[doc])
            doc += 1


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each text and benchmark item it holds: ``doc_id, item_id, n_tokens, n_agree``.

    A text holds an item if, laid over it at some offset, four fifths of the
    item's tokens agree, or four fifths in some window of ``WINDOW`` tokens.
    Tokens are lower-cased words between ASCII white space.  Items of fewer than
    ``LEAST_TOKENS`` tokens and null texts hold and are held by nothing.  Repeated
    rows give a row each.  The benchmark is the search's query set: it is taken in
    blocks of ``BLOCK_BYTES``, each met by all texts.
    """
    items = benchmark.select(F.col("item_id").cast("long"), text_bytes().alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
    found = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        index = SeedIndex([(r["item_id"], bytes(r["text"])) for r in part.collect()])
        hits = rows.mapInArrow(_search(index), "doc_id long, item_id long, n_tokens long, n_agree long")
        found = hits if found is None else found.unionByName(hits)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the texts that hold a benchmark item, all columns kept; rows without an id are looked at, too."""
    key = fresh(docs, "held")
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(bad.hint("merge"), docs["doc_id"].cast("long").eqNullSafe(bad[key]), "left_anti")
