"""Repeated byte strings across documents, by prefix-free parsing.

A rolling hash of ``KMER`` bytes triggers phrase borders: every window of
``LENGTH`` bytes belongs to the trigger with the smallest hash inside it (the
leftmost of equals), so equal windows belong to equal triggers at equal offsets.
The consecutive windows of one trigger make a phrase.  Equal phrases meet as
hashes; only the first of each enters the dictionary, all windows of the others
are repeats.  Dictionary phrases that share a trigger are put in suffix order,
and of equal neighbours all but the earliest are repeats, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import staged, text_bytes

LENGTH = 100
KMER = 16
SPAN = LENGTH - KMER + 1
# Bits of a sort key that hold the position; longer texts are parsed in pieces that overlap by a window.
PLACE_BITS = 24
PIECE = (1 << PLACE_BITS) - 1
# Phrases a task sorts before it sends them on.
SENT_PHRASES = 1_500_000
# Phrases are cut at these offsets to their trigger before they are put in suffix order; what all
# windows between two cuts share names their group, so a trigger in very many phrases is no single group.
STRIDE = 32
MIX = np.uint64(0x9E3779B97F4A7C15)

SENT = "bucket int, trigger binary, phrase binary, doc binary, start binary, shape binary"
FOUND = "doc_id long, start long, shape int, shared boolean"
REMOVED = "doc_id long, start long, windows int"


def _rolled(data: bytes) -> np.ndarray:
    """A hash of the ``KMER`` bytes from every position, from those of their halves."""
    rolled, width = np.frombuffer(data, np.uint8).astype(np.uint64), 1
    while width < KMER:
        rolled = (rolled[:-width] * MIX + rolled[width:]) * np.uint64(0xD6E8FEB86659FD93)
        rolled ^= rolled >> np.uint64(31)
        width *= 2
    return rolled


def _sliding_min(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours, by prefix and suffix minima of blocks."""
    size = len(keys) - span + 1
    blocks = -(-len(keys) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:size], ahead[span - 1 : span - 1 + size])


def parse(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of a text: their starts, shapes and the hashes of their triggers.

    A shape is the number of windows plus 256 times the trigger's offset in the first.
    """
    size = len(data)
    if size < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.uint64)
    if size > PIECE:
        step = PIECE - LENGTH + 1
        lows = range(0, size - LENGTH + 1, step)
        parts = [parse(data[low : low + PIECE]) for low in lows]
        starts = np.concatenate([p[0] + low for low, p in zip(lows, parts, strict=True)])
        return starts, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    rolled = _rolled(data)
    place = np.arange(len(rolled), dtype=np.uint64)
    least = _sliding_min(rolled >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | place, SPAN)
    starts = np.flatnonzero(np.diff(least, prepend=least[0] + np.uint64(1)))
    windows = np.diff(starts, append=len(least))
    triggers = (least[starts] & np.uint64(PIECE)).astype(np.int64)
    return starts, (windows + 256 * (triggers - starts)).astype(np.uint16), rolled[triggers]


def _leads(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: which are the first of equals, and for every row the place of its first."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return changed, np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _joined(doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with those that follow each other in one document made one."""
    order = np.lexsort((start, doc))
    doc, start, windows = doc[order], start[order], windows[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + windows[:-1])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.add.reduceat(windows, at)


def _send(buckets: int):
    """Phrases of all texts: the first of equals in the task goes to its trigger's owner, the others are settled here."""

    def rows(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, start, shape, trigger, phrase = (np.concatenate(column) for column in zip(*held, strict=True))
        order = np.lexsort((start, doc, phrase))
        doc, start, shape, trigger, phrase = (x[order] for x in (doc, start, shape, trigger, phrase))
        leads, lead = _leads(phrase)
        rest = np.flatnonzero((doc != doc[lead]) | (start != start[lead]))
        at = np.flatnonzero(leads)
        owner = (trigger[at] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        at, owner = at[order], owner[order]
        out: list[tuple] = []
        for own in np.split(at, np.flatnonzero(np.diff(owner)) + 1):
            within = (trigger[own] // np.uint64(buckets)).astype(np.uint32)
            columns = (within, phrase[own], doc[own], start[own], shape[own])
            out.append((int(trigger[own[0]] % np.uint64(buckets)), *(c.tobytes() for c in columns)))
        if len(rest):
            runs = _joined(doc[rest], start[rest], (shape[rest] & 255).astype(np.int64))
            out.append((-1, None, None, *(c.tobytes() for c in runs)))
        kinds = (pa.int32(), *[pa.binary()] * 5)
        names = ["bucket", "trigger", "phrase", "doc", "start", "shape"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        digest = xxhash.xxh3_64_intdigest
        for frame in frames:
            for doc, data in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                start, shape, trigger = parse(data)
                if not len(start):
                    continue
                ends = start + (shape & 255) + (LENGTH - 1)
                view = memoryview(data)
                bounds = zip(start.tolist(), ends.tolist(), strict=True)
                phrase = np.fromiter((digest(view[low:high]) for low, high in bounds), np.uint64, len(start))
                held.append((np.full(len(start), doc, np.int64), start.astype(np.int64), shape, trigger, phrase))
                count += len(start)
                if count >= SENT_PHRASES:
                    yield rows(held)
                    held, count = [], 0
        if held:
            yield rows(held)

    return run


def _meet(sent: pd.DataFrame) -> pd.DataFrame:
    """For one owner: phrases that start earlier elsewhere, and dictionary phrases that share a trigger."""
    kinds = {"trigger": np.uint32, "phrase": np.uint64, "doc": np.int64, "start": np.int64, "shape": np.uint16}
    read = (np.concatenate([np.frombuffer(x, kind) for x in sent[name]]) for name, kind in kinds.items())
    trigger, phrase, doc, start, shape = read
    order = np.lexsort((start, doc, phrase, trigger))
    trigger, phrase, doc, start, shape = (x[order] for x in (trigger, phrase, doc, start, shape))
    leads, lead = _leads(trigger, phrase)
    again = (doc != doc[lead]) | (start != start[lead])
    _, inverse, variants = np.unique(trigger[leads], return_inverse=True, return_counts=True)
    shared = np.zeros(len(leads), bool)
    shared[np.flatnonzero(leads)[variants[inverse] > 1]] = True
    chosen = again | shared
    columns = {"doc_id": doc, "start": start, "shape": shape.astype(np.int32), "shared": shared}
    return pd.DataFrame({name: column[chosen] for name, column in columns.items()})


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _settled(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpack what the sending tasks have settled by themselves."""
    for frame in frames:
        for doc, start, shape in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            windows = np.frombuffer(shape, np.int64).astype(np.int32)
            columns = (np.frombuffer(doc, np.int64), np.frombuffer(start, np.int64), windows)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "start", "windows"])


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed before they are shuffled."""
    pack = zstandard.ZstdCompressor(level=1)
    for frame in frames:
        data = pa.array([pack.compress(x) for x in frame.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([frame.column(0), data], ["doc_id", "packed"])


def _cuts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of dictionary phrases, cut by ``STRIDE``; of equal cuts of a batch all but the first are settled."""
    unpack = zstandard.ZstdDecompressor()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    for frame in frames:
        found: dict[bytes, list[tuple[int, int, int, int]]] = {}
        for doc, packed, phrases in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            data = unpack.decompress(packed)
            for phrase in phrases:
                first, shape = phrase["start"], phrase["shape"]
                end, trigger = first + (shape & 255), first + (shape >> 8)
                while first < end:
                    low = (trigger - first) // STRIDE * STRIDE
                    last = min(end, trigger - low + 1)
                    # What every window from offset low to low + STRIDE - 1 holds, whichever of them are here.
                    core = xxhash.xxh3_64_intdigest(data[trigger - low : trigger - low + LENGTH - STRIDE + 1])
                    cut = data[first : last - 1 + LENGTH]
                    found.setdefault(cut, []).append((doc, first, core - 2**63, last - first))
                    first = last
        out = []
        for cut, places in found.items():
            lead = min(places)
            for doc, first, core, windows in places:
                out.append((core, doc, first, windows, cut if (doc, first) == lead[:2] else None))
        yield _batch(out, kinds, ["core", "doc_id", "start", "windows", "data"])


def _suffix_order(cuts: pd.DataFrame) -> pd.DataFrame:
    """Put the windows of cuts with a common core in order; all but the earliest of equals are repeats."""
    removed: list[tuple[int, int, int]] = []
    for _, group in cuts.groupby("core", sort=False).indices.items() if len(cuts) else ():
        if len(group) == 1:
            continue
        docs, starts, datas = (cuts[name].to_numpy()[group] for name in ("doc_id", "start", "data"))
        suffixes = sorted(
            (data[at : at + LENGTH], int(doc), int(start) + at)
            for doc, start, data in zip(docs, starts, datas, strict=True)
            for at in range(len(data) - LENGTH + 1)
        )
        lead = suffixes[0]
        places = []
        for suffix in suffixes[1:]:
            if suffix[0] != lead[0]:
                lead = suffix
            elif suffix[1:] != lead[1:]:
                places.append(suffix[1:])
        for doc, start in sorted(places):
            if removed and removed[-1][0] == doc and removed[-1][1] + removed[-1][2] == start:
                removed[-1] = (doc, removed[-1][1], removed[-1][2] + 1)
            else:
                removed.append((doc, start, 1))
    return pd.DataFrame(removed, columns=["doc_id", "start", "windows"]).astype({"windows": np.int32})


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, start, windows``: runs of 100-byte windows that also start earlier."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    sent = staged(texts.mapInArrow(_send(4 * width), SENT), "phrases")
    found = staged(sent.where("bucket >= 0").groupBy("bucket").applyInPandas(_meet, FOUND), "met")
    settled = sent.where("bucket < 0").select("doc", "start", "shape").mapInArrow(_settled, REMOVED)
    again = found.where("NOT shared").select("doc_id", "start", F.expr("shape & 255").alias("windows"))
    shared = found.where("shared").groupBy("doc_id").agg(F.collect_list(F.struct("start", "shape")).alias("phrases"))
    holders = texts.where(F.octet_length("data") >= LENGTH).mapInArrow(_packed, "doc_id long, packed binary")
    cuts = staged(
        holders.join(shared, "doc_id")
        .select("doc_id", "packed", "phrases")
        .mapInArrow(_cuts, "core long, doc_id long, start long, windows int, data binary"),
        "cuts",
    )
    known = cuts.where("data IS NULL").select("doc_id", "start", "windows")
    ordered = (
        cuts.where("data IS NOT NULL")
        .groupBy(F.pmod("core", F.lit(4 * width)))
        .applyInPandas(lambda group: _suffix_order(group), REMOVED)
    )
    return settled.unionByName(again).unionByName(known).unionByName(ordered)


def _cleaned(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    for frame in frames:
        out = []
        for doc, packed, runs in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            data = unpack.decompress(packed)
            kept, removed, spans = without_runs(data, runs or [])
            out.append((doc, len(data), removed, spans, hashlib.sha256(kept).hexdigest()))
        yield _batch(out, kinds, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_runs(data: bytes, runs: list[dict]) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, in how many maximal runs."""
    if not runs:
        return data, 0, 0
    steps = np.zeros(len(data) + 1, np.int64)
    starts = np.array([r["start"] for r in runs])
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + np.array([r["windows"] for r in runs]) + LENGTH - 1, -1)
    gone = np.cumsum(steps[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte covered by a 100-byte string that also starts earlier is removed:
    in a document of smaller id, or earlier in the same one.  Null texts are
    empty; texts under 100 bytes are kept whole.  A document without an id is
    compared with nothing.  Repeated rows of one id count as the same place, so
    they do not remove each other.  Other columns are not read.
    """
    runs = repeated_windows(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    packed = texts.mapInArrow(_packed, "doc_id long, packed binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return packed.join(runs, "doc_id", "left").select("doc_id", "packed", "runs").mapInArrow(_cleaned, schema)
