"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece, the last token of the prefix's BPE encoding
is unique, and it is the one token ending there that forms a valid pair with
the last token of what precedes it (a pair is valid when BPE of the two
tokens' bytes gives back exactly those two tokens).  So one left-to-right pass
fills ``last[i]`` for every prefix end ``i``: the tokens ending at ``i`` come
from an Aho-Corasick automaton over all tokens, the pair test from a small
memo.  Walking ``last`` back from the end gives the encoding.

The states allow exact appends (extend ``last`` past the old end) and
re-encoding near edits (:meth:`PrefixEncoder.reencode` keeps the states
before the edit and recomputes only the rest).

Texts are split into pieces by the pattern of the rank file first, as the
tiktoken library does; no special tokens are recognised.  Each worker keeps
the encodings of recent pieces in a memo bounded in bytes and emptied after
each task.  If a piece ever had no valid last token (it never happens for the
public rank files, and is counted in ``fallbacks``), it is encoded by plain
merging instead.

Defined results: a null text encodes as the empty text (no ids, empty decoded
bytes); other columns, repeated rows and null ids pass unchanged.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows one Arrow slice carries into and out of a worker.
ROWS = 256
# Bytes of pieces and ids the per-worker memo holds before it is emptied.
MEMO_BYTES = 32 << 20
# Pairs of tokens whose validity the memo keeps.
PAIRS = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: one base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class PrefixEncoder:
    """Encodes bytes by the unique last token of every prefix; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pieces = regex.compile(pattern)
        self.token = {rank: data for data, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for data, rank in ranks.items():
            self.automaton.add_word(data.decode("latin-1"), (rank, len(data)))
        self.automaton.make_automaton()
        self.longest = max(map(len, ranks), default=1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.memo_bytes = 0
        self.fallbacks = 0

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE: merge the adjacent pair of lowest rank, leftmost first, until none is a token."""
        cuts = list(range(len(data) + 1))
        while len(cuts) > 2:
            best, at = None, -1
            for i in range(len(cuts) - 2):
                rank = self.ranks.get(data[cuts[i] : cuts[i + 2]])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            del cuts[at + 1]
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def valid_pair(self, left: int, right: int) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.token[left] + self.token[right]) == [left, right]
        return found

    def states(self, data: bytes, last: list[int] | None = None, start: int = 0) -> list[int]:
        """``last[i]``, the last token of the encoding of ``data[:i]``, for every ``i``; kept below ``start``."""
        last = (last or [-1])[: start + 1] + [-1] * (len(data) - start)
        text = data.decode("latin-1")
        begin = max(0, start - self.longest)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(text, begin):
            i = end + 1
            if i <= start or last[i] != -1:
                continue
            j = i - length
            if j == 0:
                last[i] = token
                continue
            before = last[j]
            if before < 0:
                continue
            valid = pairs.get((before, token))
            if valid is None:
                valid = self.valid_pair(before, token)
            if valid:
                last[i] = token
        return last

    def walk(self, last: list[int]) -> list[int] | None:
        """The encoding that the states give, or None if a prefix has no valid last token."""
        out, i = [], len(last) - 1
        while i > 0:
            token = last[i]
            if token < 0:
                return None
            out.append(token)
            i -= len(self.token[token])
        return out[::-1]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece of the pattern; remembered by the piece's text."""
        data = piece.encode("utf-8")
        rank = self.ranks.get(data)
        if rank is not None:
            found: tuple[int, ...] = (rank,)
        else:
            ids = self.walk(self.states(data))
            if ids is None:
                self.fallbacks += 1
                ids = self.merged(data)
            found = tuple(ids)
        if self.memo_bytes > MEMO_BYTES:
            self.memo.clear()
            self.memo_bytes = 0
        self.memo[piece] = found
        self.memo_bytes += 2 * len(data) + 8 * len(found) + 120
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text: each piece of the pattern encoded on its own."""
        memo, out = self.memo, []
        for piece in self.pieces.findall(text):
            found = memo.get(piece)
            out += found if found is not None else self.encode_piece(piece)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def reencode(self, last: list[int], new: bytes, edit: int) -> tuple[list[int], list[int]]:
        """States and ids of ``new``, which equals the old bytes before ``edit``: the states below are kept."""
        states = self.states(new, last, min(edit, len(new)))
        ids = self.walk(states)
        return states, (ids if ids is not None else self.merged(new))

    def end_task(self) -> None:
        self.memo.clear()
        self.memo_bytes = 0


@lru_cache(maxsize=2)
def _tokens(name: str) -> dict[int, bytes]:
    return {rank: data for data, rank in read_ranks(SparkFiles.get(name)).items()}


@lru_cache(maxsize=2)
def _encoder(name: str, pattern: str) -> PrefixEncoder:
    """The rank file that was added to the job's files under ``name``; compiled once per worker."""
    return PrefixEncoder(read_ranks(SparkFiles.get(name)), pattern)


def _ship(df: DataFrame, ranks_file: str) -> str:
    df.sparkSession.sparkContext.addFile(ranks_file)
    return ranks_file.rsplit("/", 1)[-1]


def _slices(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for low in range(0, frame.num_rows, ROWS):
            yield frame.slice(low, ROWS)


def encode(docs: DataFrame, ranks_file: str, pattern: str, text_column: str = "text", ids_column: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids_column`` (which replaces a column of that name)."""
    name = _ship(docs, ranks_file)
    keep = [c for c in docs.columns if c != ids_column]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != ids_column), T.StructField(ids_column, T.ArrayType(T.IntegerType()))])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, pattern)
        try:
            for frame in _slices(frames):
                texts = frame.column(text_column).to_pylist()
                ids = [coder.encode(t) if t else [] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [frame.column(c) for c in keep] + [pa.array(ids, pa.list_(pa.int32()))], names=[*keep, ids_column]
                )
        finally:
            coder.end_task()

    return docs.select(*keep).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_file: str, ids_column: str = "token_ids", bytes_column: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids of ``ids_column`` stand for in ``bytes_column`` (null ids: empty)."""
    name = _ship(df, ranks_file)
    keep = [c for c in df.columns if c != bytes_column]
    schema = T.StructType([*(f for f in df.schema.fields if f.name != bytes_column), T.StructField(bytes_column, T.BinaryType())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(name)
        for frame in _slices(frames):
            ids = frame.column(ids_column).to_pylist()
            out = [b"".join(token[i] for i in x) if x else b"" for x in ids]
            yield pa.RecordBatch.from_arrays([frame.column(c) for c in keep] + [pa.array(out, pa.binary())], names=[*keep, bytes_column])

    return df.select(*keep).mapInArrow(run, schema)


def ids_sha256(ids: str) -> Column:
    """Lowercase hex SHA-256 of the ids as little-endian unsigned 32-bit integers, in Spark alone."""
    def little(i: Column) -> Column:
        h = F.lpad(F.hex(i.cast("long")), 8, "0")
        return F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))

    return F.sha2(F.unhex(F.array_join(F.transform(F.coalesce(F.col(ids), F.array().cast("array<int>")), little), "")), 256)


_DIGESTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def digests(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip`` of every document.

    One pass: each text is encoded and its ids decoded again by the operator;
    the digests are taken from those ids and bytes (ids as little-endian
    unsigned 32-bit integers), and ``round_trip`` tells whether the bytes are
    the text's UTF-8.
    """
    name = _ship(docs, ranks_file)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(name, pattern)
        try:
            for frame in _slices(frames):
                n, ids_hex, bytes_hex, same = [], [], [], []
                for text in frame.column("text").to_pylist():
                    text = text or ""
                    ids = coder.encode(text)
                    decoded = coder.decode(ids)
                    n.append(len(ids))
                    ids_hex.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                    bytes_hex.append(hashlib.sha256(decoded).hexdigest())
                    same.append(decoded == text.encode("utf-8"))
                yield pa.RecordBatch.from_arrays(
                    [frame.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(bytes_hex), pa.array(same)],
                    names=[f.name for f in _DIGESTS.fields],
                )
        finally:
            coder.end_task()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _DIGESTS)


def plain_sha256(ids) -> str:
    """The same digest of ids in Python, for tests."""
    return hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
