"""Set-similarity join of documents on word shingles by T-occurrence search.

Two sets of sizes ``a`` and ``b`` are similar only if they share ``T`` shingles.
Of each set the shingles with the smallest hashes are entered into inverted
lists, as many as must hold several common ones.  Lists longer than ``LONG`` are
set aside as DivideSkip does: a set that lies in few long lists is searched
through its short lists alone, since some of the occurrences that are required
must be there; only sets made up of long lists are searched through those, too.
Candidates are bounded by a parity sketch, and what remains is settled by binary
probes of the whole sets, counted up to ``T``.

Copies are one representative, and of a list every member is compared with its
first one; all others are compared only where they are not connected already:
a forest of the pairs that sketches leave possible names the documents in
question, and their whole sets are then compared where their lists lie, until
they are connected.  Lists that begin with the same document lie together, so a
family of texts that shares many lists is compared about once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import golomb
from linkloom.llm.components import components
from linkloom.llm.words import fresh, hash_cache, hashes, portions, staged, text_bytes
from linkloom.session import drop_stage

# Members from which a list counts as long.
LONG = 64
# Members of a list that one task compares with as many others; longer lists are cut into blocks.
BLOCK = 1_024
# Bits of a shingle's hash that the inverted lists are keyed by.
LIST_BITS = 44
# List entries a task sorts before it sends them on.
SENT_ENTRIES = 500_000
# Entries, and shingles of their sets, of lists that begin with the same document and are compared by one task.
LED_ENTRIES = 10_000
LED_SHINGLES = 10_000_000
# Pairs a task remembers as compared; bounds its memory, never a result.
TESTED_PAIRS = 500_000
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


@dataclass(frozen=True)
class Measure:
    """Shingles of ``width`` words; sets are similar if ``100 * common >= percent * union``."""

    width: int = 5
    percent: int = 80

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """The sorted set of shingle hashes; fewer words than a shingle's are one shingle."""
        width = min(self.width, len(words))
        if not width:
            return np.zeros(0, np.uint64)
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for at in range(width):
            part = words[at : at + len(mixed)]
            mixed = (mixed ^ (part * MULTIPLIERS[at % 5])) * np.uint64(0x9FB21C651E98DF25)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    def required(self, a, b):
        """Common shingles that sets of these sizes need."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def differing(self, n: int) -> int:
        """Shingles a set of ``n`` may have alone, at most."""
        return n - -(-self.percent * n // 100)

    def slack(self, n: int) -> int:
        return self.differing(n) // 2 + 2

    def listed(self, n: int) -> int:
        """How many of a set's smallest shingles are entered into lists."""
        return min(n, self.differing(n) + 1 + self.slack(n))

    def skips(self, n: int) -> int:
        """Long lists a set may lie in and still be searched through its short lists alone.

        The first ``skips + 1`` common shingles lie in the listed parts of both
        sets, whatever size the other has.
        """
        smallest = -(-self.percent * n // 100)
        return min(self.slack(smallest), self.slack(n))


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles in as many buckets as the next power of two; folds onto smaller ones."""
    size = max(64, 1 << max(0, int(len(shingles)) - 1).bit_length())
    buckets = ((shingles * np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(20)).astype(np.int64) & (size - 1)
    parity = (np.bincount(buckets, minlength=size) & 1).astype(np.uint8)
    return np.packbits(parity).tobytes()


def most_common(a: np.ndarray, b: np.ndarray, size_a, size_b):
    """Upper bound of the common shingles of sets with these sketches, along the last axis."""
    while a.shape[-1] != b.shape[-1]:
        if a.shape[-1] > b.shape[-1]:
            a = a[..., : a.shape[-1] // 2] ^ a[..., a.shape[-1] // 2 :]
        else:
            b = b[..., : b.shape[-1] // 2] ^ b[..., b.shape[-1] // 2 :]
    return (size_a + size_b - np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)) // 2


def _send(measure: Measure, owners: int):
    """Per document its set's size, identity and sketch; per owner of shingles one list of entries."""
    names = ["part", "owner", "coded", "runs", "docs", "places", "doc_id", "n", "low", "high", "sketch"]
    kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def entries(part: int, held: list[tuple[int, np.ndarray]]) -> list[tuple]:
        sizes = [len(s) for _, s in held]
        doc = np.repeat(np.array([d for d, _ in held]), sizes)
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
        key = np.concatenate([s for _, s in held]) >> np.uint64(64 - LIST_BITS)
        owner = (key % np.uint64(owners)).astype(np.int32)
        order = np.lexsort((doc, key, owner))
        doc, place, key, owner = doc[order], place[order], key[order], owner[order]
        out = []
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for low, high in zip(edges, np.append(edges[1:], len(owner)), strict=True):
            values, runs = np.unique(key[low:high] // np.uint64(owners), return_counts=True)
            columns = (runs.astype(np.int32), doc[low:high], place[low:high])
            packed = [golomb.encode(values), *(c.tobytes() for c in columns)]
            out.append((part, int(owner[low]), *packed, None, None, None, None, None))
        return out

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = hash_cache()
        part = TaskContext.get().partitionId() << 24
        held: list[tuple[int, np.ndarray]] = []
        seen: set[tuple[int, int, int]] = set()
        count = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )

        for frame in portions(frames, "data"):
            rows = []
            for doc, text in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                shingles = measure.shingles(hashes(text.lower().split(), cache))
                n = len(shingles)
                low = int(np.add.reduce(shingles * MULTIPLIERS[0] ^ (shingles >> np.uint64(7)))) if n else 0
                high = int(np.add.reduce((shingles ^ (shingles >> np.uint64(32))) * MULTIPLIERS[1])) if n else 0
                identity = (n, low - 2**63, high - 2**63)
                rows.append((None, None, None, None, None, None, doc, *identity, sketch(shingles) if n else None))
                if not n or doc is None or identity in seen:
                    continue
                seen.add(identity)
                held.append((doc, shingles[: measure.listed(n)].copy()))
                count += len(held[-1][1])
                if count >= SENT_ENTRIES:
                    yield batch(entries(part, held))
                    held, count, part = [], 0, part + 1
                    seen.clear()
            if rows:
                yield batch(rows)
        if held:
            yield batch(entries(part, held))

    return run


SENT = (
    "part long, owner int, coded binary, runs binary, docs binary, places binary, "
    "doc_id long, n long, low long, high long, sketch binary"
)


def _answer(lists: pd.DataFrame) -> pd.DataFrame:
    """For one owner: the length of the list behind every entry it was sent."""
    decoded = [golomb.decode(coded) for coded in lists["coded"]]
    runs = [np.frombuffer(r, np.int32) for r in lists["runs"]]
    values, inverse = np.unique(np.concatenate(decoded), return_inverse=True)
    lengths = np.bincount(inverse, np.concatenate(runs), len(values)).astype(np.int64)[inverse]
    parts = np.split(np.minimum(lengths, LONG + 1).astype(np.uint8), np.cumsum([len(d) for d in decoded])[:-1])
    return pd.DataFrame({"part": lists["part"], "owner": lists["owner"], "lengths": [p.tobytes() for p in parts]})


def _members(owners: int):
    """Entries of lists with more than one member."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for owner, coded, runs, docs, places, lengths in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                runs = np.frombuffer(runs, np.int32)
                key = np.repeat(golomb.decode(coded) * np.uint64(owners) + np.uint64(owner), runs).astype(np.int64)
                lengths = np.repeat(np.frombuffer(lengths, np.uint8), runs)
                kept = lengths > 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[kept]),
                        pa.array(np.frombuffer(docs, np.int64)[kept]),
                        pa.array(np.frombuffer(places, np.int32)[kept]),
                        pa.array(lengths[kept] > LONG),
                    ],
                    ["token", "doc_id", "place", "long"],
                )

    return run


def _bounded(measure: Measure):
    """Pairs whose sketches leave enough common shingles possible."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in portions(frames, "sa", "sb"):
            kept = []
            columns = [frame.column(name).to_pylist() for name in ("na", "nb", "sa", "sb")]
            for na, nb, sa, sb in zip(*columns, strict=True):
                bound = most_common(np.frombuffer(sa, np.uint8), np.frombuffer(sb, np.uint8), na, nb)
                kept.append(bool(bound >= measure.required(na, nb)))
            yield frame.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


class Forest:
    """Which of some numbered items are connected."""

    def __init__(self, size: int) -> None:
        self.above = list(range(size))

    def root(self, at: int) -> int:
        above = self.above
        while above[at] != at:
            above[at] = above[above[at]]
            at = above[at]
        return at

    def join(self, a: int, b: int) -> None:
        self.above[self.root(b)] = self.root(a)


def _lists(entries: pd.DataFrame, place: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Of every list, or pair of its blocks: the places of the documents on either side, and whether that is the whole list."""
    entries = entries.sort_values(["token", "one", "other"], kind="stable")
    keys = entries[["token", "one", "other"]].to_numpy()
    docs = np.array([place[d] for d in entries["doc_id"].tolist()], np.int64)
    side, blocks = entries["block"].to_numpy(), entries["blocks"].to_numpy()
    bounds = [0, *(np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1).tolist(), len(entries)]
    for low, high in zip(bounds, bounds[1:]):
        if high > low:
            here = side[low:high]
            left = np.unique(docs[low:high][here == keys[low, 1]])
            yield left, np.unique(docs[low:high][here == keys[low, 2]]), bool(blocks[low] == 1)


def _candidates(measure: Measure, sizes: np.ndarray, sketches: list[bytes], comps: np.ndarray):
    """For a document and others: those of other components that their sketches leave possible, the likeliest first."""
    widths = np.array([len(x) for x in sketches])
    grids, within = {}, np.zeros(len(sketches), np.int64)
    for w in np.unique(widths):
        grids[w] = np.stack([np.frombuffer(sketches[i], np.uint8) for i in np.flatnonzero(widths == w)])
        within[widths == w] = np.arange((widths == w).sum())

    def find(i: int, others: np.ndarray) -> list[int]:
        ratio = measure.percent * np.maximum(sizes[others], sizes[i]) <= 100 * np.minimum(sizes[others], sizes[i])
        near = others[ratio & (comps[others] != comps[i])]
        if not len(near):
            return []
        own, margin = grids[widths[i]][within[i]], np.empty(len(near), np.int64)
        for w in np.unique(widths[near]):
            some = widths[near] == w
            bound = most_common(grids[w][within[near[some]]], own[None, :], sizes[near[some]], sizes[i])
            margin[some] = bound - measure.required(sizes[near[some]], sizes[i])
        return near[np.argsort(-margin, kind="stable")][: int((margin >= 0).sum())].tolist()

    return find


# Documents up to which a list is compared pair by pair in plain integers; larger ones as arrays.
FEW = 48


def _questioned(measure: Measure):
    """A forest of the pairs of different components that sketches leave possible: it touches every document of such a pair.

    The first member of a list was compared with all others before.
    """

    def run(entries: pd.DataFrame) -> pd.DataFrame:
        known = entries.drop_duplicates("doc_id").sort_values("doc_id")
        docs, sizes, bits, comps = (known[c].tolist() for c in ("doc_id", "n", "sketch", "component"))
        find = _candidates(measure, np.array(sizes, np.int64), bits, np.array(comps, np.int64))
        whole = [int.from_bytes(x, "big") for x in bits]
        forest, found = Forest(len(docs)), set()
        tested: set[int] = set()

        def possible(i: int, j: int) -> bool:
            if comps[i] == comps[j] or measure.percent * max(sizes[i], sizes[j]) > 100 * min(sizes[i], sizes[j]):
                return False
            pair = i * len(docs) + j
            if pair in tested:
                return False
            if len(tested) >= TESTED_PAIRS:
                tested.clear()
            tested.add(pair)
            x, y, width, narrow = whole[i], whole[j], 8 * len(bits[i]), 8 * len(bits[j])
            if width < narrow:
                x, y, width, narrow = y, x, narrow, width
            while width > narrow:
                width //= 2
                x = (x >> width) ^ (x & ((1 << width) - 1))
            return (sizes[i] + sizes[j] - (x ^ y).bit_count()) // 2 >= measure.required(sizes[i], sizes[j])

        def joined(i: int, j: int) -> None:
            if forest.root(i) != forest.root(j):
                forest.join(i, j)
                found.update((docs[i], docs[j]))

        for left, right, same in _lists(entries, {d: i for i, d in enumerate(docs)}):
            if same and len(left) <= FEW:
                members = left.tolist()[1:]
                for at, j in enumerate(members):
                    for i in members[:at]:
                        if possible(i, j):
                            joined(i, j)
                continue
            for i in left.tolist():
                roots = np.array([forest.root(j) for j in right.tolist()], np.int64)
                for j in find(i, right[roots != forest.root(i)]):
                    joined(i, j)
        return pd.DataFrame({"doc_id": sorted(found)}, dtype=np.int64)

    return run


def _connected(measure: Measure):
    """Pairs whose whole sets are similar, as many as connect what any of them connects."""

    def run(entries: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.drop_duplicates("node")
        docs = known["node"].tolist()
        sets = [np.frombuffer(x, np.uint64) for x in known["shingles"]]
        comps = known["component"].to_numpy()
        find = _candidates(measure, np.array([len(x) for x in sets], np.int64), [sketch(x) for x in sets], comps)
        forest, found = Forest(len(docs)), []
        tested: set[int] = set()
        first = {c: i for i, c in reversed(list(enumerate(comps.tolist())))}
        for i, c in enumerate(comps.tolist()):
            forest.join(first[c], i)
        for left, right, _ in _lists(entries, {d: i for i, d in enumerate(docs)}):
            for i in left.tolist():
                roots = np.array([forest.root(j) for j in right.tolist()], np.int64)
                for j in find(i, right[roots != forest.root(i)]):
                    pair = min(i, j) * len(docs) + max(i, j)
                    if pair in tested or forest.root(i) == forest.root(j):
                        continue
                    if len(tested) >= TESTED_PAIRS:
                        tested.clear()
                    tested.add(pair)
                    needed = int(measure.required(len(sets[i]), len(sets[j])))
                    if common(sets[i], sets[j], needed) >= needed:
                        forest.join(i, j)
                        found.append((docs[i], docs[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return run


def _packed_sets(measure: Measure):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, unpack = hash_cache(), zstandard.ZstdDecompressor()
        for frame in portions(frames, "packed"):
            sets = [
                measure.shingles(hashes(unpack.decompress(p).lower().split(), cache)).tobytes()
                for p in frame.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return run


def common(a: np.ndarray, b: np.ndarray, needed: int) -> int:
    """Common elements of sorted sets by binary probes of the longer, given up once ``needed`` is out of reach."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    found = 0
    for low in range(0, len(few), 256):
        if found + len(few) - low < needed:
            return found
        part = few[low : low + 256]
        at = np.minimum(np.searchsorted(many, part), len(many) - 1)
        found += int((many[at] == part).sum())
    return found


def _similar(measure: Measure):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in portions(frames, "xa", "xb"):
            kept = []
            for x, y in zip(frame.column("xa").to_pylist(), frame.column("xb").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                needed = int(measure.required(len(a), len(b)))
                kept.append(common(a, b, needed) >= needed)
            yield frame.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _compressed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for frame in portions(frames, "data"):
        data = pa.array([pack.compress(x) for x in frame.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([frame.column(0), data], ["doc_id", "packed"])


def _sets(wanted: DataFrame, docs: DataFrame, measure: Measure) -> DataFrame:
    """``doc_id, shingles`` of the ``wanted`` ids.  Texts are shuffled once, compressed; only these sets go on."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    packed = texts.mapInArrow(_compressed, "doc_id long, packed binary")
    # By shuffles even where the ids are few: a broadcast would leave both Python steps in one task.
    sets = packed.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_packed_sets(measure), "doc_id long, shingles binary")
    return staged(sets.dropDuplicates(["doc_id"]), "sets")


def _verified(pairs: DataFrame, docs: DataFrame, measure: Measure) -> DataFrame:
    """The pairs whose whole sets are similar."""
    pairs = staged(pairs, "candidates")
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), docs, measure)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb")), "b"
    )
    links = staged(both.mapInArrow(_similar(measure), "a long, b long"), "links")
    drop_stage(sets)
    return links


def _led(labelled: DataFrame, least: int) -> DataFrame:
    """Entries ``token, doc_id, n, component`` of lists with ``least`` members and several components, long lists as pairs of blocks, under the task ``led`` that compares them.

    A task's lists begin with the same document; those of a document with very many entries are dealt to several tasks.
    """
    mixed = (
        labelled.groupBy("token")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.min("doc_id").alias("lead"),
            F.count("*").alias("members"),
            F.sum("n").alias("shingles"),
        )
        .where((F.col("least") != F.col("most")) & (F.col("members") >= least))
        .select("token", "lead", "members", "shingles", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    )
    mixed = staged(mixed, "mixed")
    share = F.greatest(F.sum("members") / LED_ENTRIES, F.sum("shingles") / LED_SHINGLES)
    leads = mixed.groupBy("lead").agg(F.ceil(share).cast("int").alias("salts"))
    mixed = mixed.join(leads, "lead").select("token", "lead", "blocks", F.pmod("token", "salts").alias("salt"))
    blocked = labelled.join(mixed, "token").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    spread = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")).withColumns(
        {"one": F.least("block", "with"), "other": F.greatest("block", "with")}
    )
    return spread.select(
        "token", "doc_id", "n", "component", "blocks", "block", "one", "other", F.xxhash64("lead", "salt", "one", "other").alias("led")
    )


def similar_documents(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    The component is the smallest id reachable by links between similar sets.
    Null texts and texts without words have no shingles and link with nothing;
    a document without an id links with nothing and has no component.  Rows that
    repeat an id belong to one component.  Other columns are not read.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    owners = 2 * width
    sent = staged(texts.mapInArrow(_send(measure, owners), SENT), "lists")
    sets = staged(sent.where("owner IS NULL").select("doc_id", "n", "low", "high", "sketch"), "identities")
    entries = sent.where("owner IS NOT NULL").select("part", "owner", "coded", "runs", "docs", "places")
    classes = staged(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "low", "high").agg(F.min("doc_id").alias("rep")), "classes"
    )
    rep_sets = classes.select(F.col("rep").alias("doc_id")).join(
        sets.where("doc_id IS NOT NULL").select("doc_id", "n", "sketch").dropDuplicates(["doc_id"]), "doc_id"
    )
    rep_sets = staged(rep_sets, "representatives")

    answers = (
        entries.select("part", "owner", "coded", "runs")
        .groupBy("owner")
        .applyInPandas(_answer, "part long, owner int, lengths binary")
    )
    # Stored, so that no task runs two Python workers at once, one behind the other.
    answers = staged(answers, "answers")
    members = entries.join(answers, ["part", "owner"]).select("owner", "coded", "runs", "docs", "places", "lengths")
    members = staged(members.mapInArrow(_members(owners), "token long, doc_id long, place int, long boolean"), "members")
    drop_stage(sent)
    drop_stage(answers)
    # Of copies any one may have been listed; it stands for its representative.
    standing = sets.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "low", "high").dropDuplicates(["doc_id"])
    standing = standing.join(classes, ["n", "low", "high"]).select("doc_id", "rep", "n")
    listed, members = members, staged(
        members.join(standing, "doc_id").select("token", F.col("rep").alias("doc_id"), "n", "long"), "representative-members"
    )
    drop_stage(listed)
    # Which documents are searched through short lists alone.
    percent, n = measure.percent, F.col("n")
    differing = lambda size: size - F.ceil(size * percent / 100)
    slack = lambda size: F.floor(differing(size) / 2) + 2
    skips = F.least(slack(F.ceil(n * percent / 100)), slack(n))
    deep = members.groupBy("doc_id", "n").agg(F.sum(F.col("long").cast("int")).alias("n_long")).where(F.col("n_long") > skips)
    lists = members.join(deep.select("doc_id", F.lit(True).alias("deep")), "doc_id", "left").where("NOT long OR deep")
    lists = staged(lists.select("token", "doc_id", "n"), "searched")
    drop_stage(members)

    ratio = lambda a, b: F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")
    first = lists.groupBy("token").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.count("*").alias("members"))
    first = staged(first.where("members > 1").select("token", "first.*", "members"), "firsts")
    sketches = rep_sets.select("doc_id", "n", "sketch")
    star = (
        lists.join(first.select("token", F.col("doc_id").alias("a"), F.col("n").alias("na")), "token")
        .where((F.col("a") != F.col("doc_id")) & ratio("na", "n"))
        .select("a", F.col("doc_id").alias("b"))
        .distinct()
    )
    sided = star.join(sketches.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a").join(
        sketches.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b"
    )
    links = _verified(sided.mapInArrow(_bounded(measure), "a long, b long"), docs, measure)
    drop_stage(first)
    labels = components(links)

    # What is not connected yet: members of lists with several components.
    labelled = lists.join(labels, lists["doc_id"] == labels["node"], "left").select(
        "token", "doc_id", "n", F.coalesce("component", "doc_id").alias("component")
    )
    labelled = staged(labelled, "labelled")
    parts = F.pmod("led", F.lit(4 * width))
    questioned = (
        _led(labelled, 3)
        .join(sketches.drop("n"), "doc_id")
        .groupBy(parts)
        .applyInPandas(_questioned(measure), "doc_id long")
        .distinct()
    )
    questioned = staged(questioned, "questioned")
    asked = staged(_led(labelled.join(questioned, "doc_id", "left_semi"), 2).withColumn("part", parts), "asked")
    whole = _sets(questioned, docs, measure)
    needed = asked.select(F.col("part").alias("of"), F.col("doc_id").alias("node"), "component").distinct()
    needed = needed.join(whole.withColumnRenamed("doc_id", "node"), "node")
    more = (
        asked.select("part", "token", "doc_id", "blocks", "block", "one", "other")
        .groupBy("part")
        .cogroup(needed.groupBy("of"))
        .applyInPandas(_connected(measure), "a long, b long")
    )
    more = staged(more.distinct(), "links")
    for used in (lists, labelled, questioned, asked, whole):
        drop_stage(used)
    labels = components(links.unionByName(more))

    known = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "n", "low", "high", F.coalesce("component", "rep").alias("component_id")
    )
    rows = sets.select("doc_id", "n", "low", "high")
    return rows.join(staged(known, "classes"), ["n", "low", "high"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; all columns kept."""
    groups = similar_documents(docs, measure)
    key = fresh(docs, "gone")
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone[key], "left_anti")
