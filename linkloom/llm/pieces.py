"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled once per worker into a transducer whose arcs read the
characters of a piece and write its id.  Weights live in the tropical semiring:
a unigram model gives each piece its negated score; in a merge (BPE) model two
pieces may follow each other at weight zero if merging their joint text yields
just these two, and at weight infinity otherwise, which leaves one finite path,
the model's own segmentation.  Composition with an input is done lazily, word by
word, since no piece reaches across the start of a word.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.words import WordCache

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# A piece outside the vocabulary costs this much more than the worst one, as in the public library.
UNKNOWN_PENALTY = 10.0
# Pairs of pieces whose weight a worker remembers, and rows it encodes or decodes at once; both bound its memory.
KNOWN_PAIRS = 600_000
ROWS = 128
# Encoded words a worker remembers.
ENCODED_WORDS = 600_000
INFINITE = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


class PieceTransducer:
    """A compiled model: normaliser, pieces and byte fallback."""

    def __init__(self, model: bytes) -> None:
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: list[float] = []
        self.model_type, self.dummy_prefix, self.squeeze = UNIGRAM, True, True
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                self.model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("models with a character map are not supported")
                self.dummy_prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        if self.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        usable = (NORMAL, USER_DEFINED)
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)) if kind in usable}
        self.unknown = next((i for i, kind in enumerate(self.kinds) if kind == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.longest = max(map(len, self.ids), default=1)
        # Every beginning of a piece, with the id of the piece that it is, or -1.
        self.spelled = {p[:end]: -1 for p in self.ids for end in range(1, len(p))} | self.ids
        self.worst = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        alphabet = {c for p in self.ids for c in p}
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        newline = r"\n|" if "\n" not in alphabet else ""
        other = rf"[^{SPACE}\n]" if newline else f"[^{SPACE}]"
        self.cut = None if crossing else re.compile(rf"{newline}{SPACE}*{other}+|{SPACE}+", re.S)
        self.follow: dict[int, bool] = {}
        self.words: WordCache[bytes] = WordCache(self._encode_word, ENCODED_WORDS)
        texts = self._decoded_pieces()
        self.letters = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    # normaliser

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    # arcs

    def fallback(self, char: str) -> list[int]:
        if self.bytes:
            return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def _merged(self, text: str) -> list[str]:
        """Merge the neighbours with the best joint piece until none is left."""
        parts, ids, scores = list(text), self.ids, self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                joint = ids.get(parts[i] + parts[i + 1])
                if joint is not None and (best is None or scores[joint] > best):
                    best, at = scores[joint], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether the piece ``right`` after ``left`` has a finite weight in a merge model."""
        key = left << 32 | right
        known = self.follow.get(key)
        if known is None:
            if len(self.follow) >= KNOWN_PAIRS:
                self.follow.clear()
            pair = [self.pieces[left], self.pieces[right]]
            known = self.follow[key] = self._merged("".join(pair)) == pair
        return known

    # shortest path of the composition with one word

    def shortest_path(self, word: str) -> list[str]:
        """Pieces of the cheapest path; a character outside the vocabulary is a piece of its own."""
        return self._cheapest(word) if self.model_type == UNIGRAM else self._finite(word)

    def _cheapest(self, word: str) -> list[str]:
        """Forward costs and back pointers, for weights on the pieces alone."""
        size = len(word)
        cost, back = [0.0] + [INFINITE] * size, [0] * (size + 1)
        for at in range(size):
            for end in range(at + 1, min(size, at + self.longest) + 1):
                found = self.ids.get(word[at:end])
                if found is None and end > at + 1:
                    continue
                total = cost[at] - (self.worst if found is None else self.scores[found])
                if total < cost[end]:
                    cost[end], back[end] = total, at
        path, at = [], size
        while at:
            path.append(word[back[at] : at])
            at = back[at]
        return path[::-1]

    def _arcs(self, word: str, at: int) -> list[tuple[int, int | None]]:
        """Where each piece that begins at ``at`` ends, and its id, the longest last; a character without a piece is one."""
        spelled, size, end = self.spelled, len(word), at + 1
        found = spelled.get(word[at:end])
        arcs: list[tuple[int, int | None]] = [(end, None if found is None or found < 0 else found)]
        while found is not None and end < size:
            end += 1
            found = spelled.get(word[at:end])
            if found is not None and found >= 0:
                arcs.append((end, found))
        return arcs

    def _finite(self, word: str) -> list[str]:
        """The path of finite weight, found depth first with the longest piece first; dead ends are remembered."""
        size, dead, follow = len(word), set(), self.follow
        path: list[tuple[int, int | None]] = []  # where each piece ends, and its id
        left: list[list[tuple[int, int | None]]] = []  # arcs not tried yet beside each piece of the path
        last, arcs = None, self._arcs(word, 0) if size else []
        while not path or path[-1][0] < size:
            while arcs:
                end, found = arc = arcs.pop()
                if found is None or last is None and arc not in dead:
                    break
                if arc not in dead:
                    known = follow.get(last << 32 | found)
                    if self.follows(last, found) if known is None else known:
                        break
            else:
                if not path:
                    return self._merged(word)
                dead.add(path.pop())
                last, arcs = path[-1][1] if path else None, left.pop()
                continue
            path.append(arc)
            left.append(arcs)
            last, arcs = found, self._arcs(word, end) if end < size else []
        starts = [0, *(end for end, _ in path[:-1])]
        return [word[low:high] for low, (high, _) in zip(starts, path, strict=True)]

    def _encode_word(self, word: str) -> bytes:
        out: list[int] = []
        for piece in self.shortest_path(word):
            found = self.ids.get(piece)
            out += [found] if found is not None else self.fallback(piece)
        return struct.pack(f"<{len(out)}i", *out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        written = self.normalise(text)
        words = self.cut.findall(written) if self.cut else [written] if written else []
        return b"".join(map(self.words.__getitem__, words))

    # decoding

    def _decoded_pieces(self) -> list[bytes]:
        out = []
        for piece, kind in zip(self.pieces, self.kinds, strict=True):
            if kind == BYTE:
                out.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                out.append(b"")
            elif kind == UNKNOWN:
                out.append(" ⁇ ".encode())
            else:
                out.append(piece.replace(SPACE, " ").encode())
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the ids between neighbouring ``offsets``."""
        sizes = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.letters[np.repeat(self.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        bounds = ends[offsets].tolist()
        space = 1 if self.dummy_prefix else 0
        out = []
        for low, high in zip(bounds, bounds[1:]):
            if space and data[low : low + 1] == b" " and low < high:
                low += 1
            out.append(data[low:high].decode("utf-8", "replace"))
        return out


def slices(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for low in range(0, frame.num_rows, ROWS):
            yield frame.slice(low, ROWS)


@lru_cache(maxsize=2)
def _compiled(name: str) -> PieceTransducer:
    """The model that was added to the job's files under ``name``; compiled once per worker."""
    with open(SparkFiles.get(name), "rb") as file:
        return PieceTransducer(file.read())


def _ship(docs: DataFrame, model_file: str) -> str:
    docs.sparkSession.sparkContext.addFile(model_file)
    return model_file.rsplit("/", 1)[-1]


def encode(docs: DataFrame, model_file: str, text_column: str = "text", ids_column: str = "piece_ids") -> DataFrame:
    """``docs`` with the piece ids of the whole text in ``ids_column``, which replaces a column of that name.

    A null text has null ids, an empty one an empty list.  All other columns and
    repeated rows stay as they are.
    """
    from pyspark.sql import types as T

    name = _ship(docs, model_file)
    kept = docs.drop(ids_column)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_column, T.ArrayType(T.IntegerType()))])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _compiled(name)
        for frame in slices(frames):
            coded = [None if t is None else transducer.encode(t) for t in frame.column(text_column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, _lists(coded)], names=[*frame.schema.names, ids_column]
            )

    return kept.mapInArrow(run, schema)


def _lists(coded: list[bytes | None]) -> pa.ListArray:
    offsets = np.zeros(len(coded) + 1, np.int32)
    offsets[1:] = np.cumsum([0 if c is None else len(c) // 4 for c in coded])
    values = pa.array(np.frombuffer(b"".join(c or b"" for c in coded), "<i4"), pa.int32())
    nulls = pa.array([c is None for c in coded], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=nulls)


def decode(docs: DataFrame, model_file: str, ids_column: str = "piece_ids", text_column: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_column`` in ``text_column``; null ids give null, no ids the empty text."""
    from pyspark.sql import types as T

    name = _ship(docs, model_file)
    kept = docs.drop(text_column)
    schema = T.StructType([*kept.schema.fields, T.StructField(text_column, T.StringType())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _compiled(name)
        for frame in slices(frames):
            lists = frame.column(ids_column)
            sizes = [0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]
            values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = transducer.decode_all(values, np.cumsum([0, *sizes]))
            decoded = pa.array(texts, pa.string(), mask=np.asarray(lists.is_null()))
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, decoded], names=[*frame.schema.names, text_column]
            )

    return kept.mapInArrow(run, schema)


def tokenised(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per document: ``doc_id, piece_ids, n_pieces, round_trip`` (whether decoding gives the text back)."""
    coded = encode(docs.select("doc_id", "text"), model_file)
    back = decode(coded, model_file)
    return back.select(
        "doc_id", "piece_ids", F.size("piece_ids").alias("n_pieces"), (F.col("text") == F.col("decoded")).alias("round_trip")
    )
