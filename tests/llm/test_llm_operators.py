"""Training-data operators against brute force, and on rows that are out of the ordinary."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import (
    decontaminate,
    exact_dedup,
    golomb,
    html_text,
    jaccard,
    languages,
    licenses,
    pieces,
    repeats,
    suffix_tree,
    toxicity,
)
from linkloom.llm.components import components
from linkloom.llm.queries import PIECE_MODEL
from linkloom.llm.words import PORTION_BYTES, WordCache
from linkloom.session import checkpoint_root, stage_table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, digest string, keep string"
WORDS = "river stone meadow lantern copper winter harbour quiet morning silver basket thunder ladder orchard velvet".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(("", "s", "ed", ",")) + str(rng.randrange(9)) for _ in range(n))


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    base = [prose(rng, n) for n in (3, 4, 5, 40, 60, 90, 120, 200, 300)]
    rows: list[tuple[int | None, str | None]] = list(enumerate(base))
    shared = prose(rng, 30)
    for text in base[3:]:
        words = text.split()
        for edits in (1, 3, 9):
            changed = list(words)
            for at in rng.sample(range(len(words)), edits):
                changed[at] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(changed)))
        rows.append((len(rows), prose(rng, 20) + " " + shared + " " + prose(rng, 25)))
        rows.append((len(rows), text))
    rows += [(len(rows) + k, t) for k, t in enumerate(("", None, "   \n", "ä" * 400, "word", "word", "ab" * 300, "A b\x00c"))]
    rows += [rows[4], (None, base[5]), (None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    languages_of = ("en", "de", None)
    rows = [(i, t, languages_of[k % 3], None, None, 7, "x", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 1000):
        for top in (1, 50, 2**44, 2**63):
            values = np.sort(rng.integers(0, top, size, dtype=np.uint64))
            assert (golomb.decode(golomb.encode(values)) == values).all()


def test_components_of_a_chain_a_star_and_pairs(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 20)] + [(500, 400), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[k] for k in range(1, 41)} == {1}
    assert {found[100 + k] for k in range(20)} == {100}
    assert found[500] == found[400] == 400


def test_exact_dedup(docs, texts, nothing):
    found = [tuple(r) for r in exact_dedup.exact_dedup(docs).collect()]
    groups: dict[str, list[int]] = {}
    for i, text in texts:
        if i is not None:
            groups.setdefault(text or "", []).append(i)
    expected = []
    for i, text in texts:
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        own = groups.get(text or "", []) if i is not None else [i]
        expected.append((i, max(own) if i is not None else None, len(own), i is None or i == max(own), digest))
    assert Counter(found) == Counter(expected)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({max(own): 1 for own in groups.values()} | {None: 2})
    assert exact_dedup.exact_dedup(nothing).count() == exact_dedup.drop_copies(nothing).count() == 0


def similar_by_brute_force(texts, width: int, percent: int):
    sets, parent = {}, {}
    for i, text in texts:
        if i is None:
            continue
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent", "long"), [(4, 85, 64), (5, 80, 2), (2, 50, 3)])
def test_similar_documents(docs, texts, nothing, monkeypatch, width, percent, long):
    monkeypatch.setattr(jaccard, "LONG", long)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    measure = jaccard.Measure(width, percent)
    found = jaccard.similar_documents(docs, measure).collect()
    expected = similar_by_brute_force(texts, width, percent)
    assert len(found) == len(texts)
    for row in found:
        if row["doc_id"] is None:
            assert row["component_id"] is None
        else:
            assert (row["n_shingles"], row["component_id"]) == expected[row["doc_id"]]
    assert len({c for _, c in expected.values()}) < len(expected)
    if long == 64:
        assert jaccard.similar_documents(nothing, measure).count() == 0
        kept = jaccard.drop_near_copies(docs, measure)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {c for _, c in expected.values()} | {None}


def test_kept_texts_move_once_and_repeated_rows_stay_once(spark):
    rows = [(1, "a b"), (2, "a b"), (2, "a b"), (2, "c"), (3, "d"), (None, "a b"), (None, "a b"), (4, None), (5, ""), (6, "e")]
    kept = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted(map(tuple, kept.collect()), key=str)
    assert found == sorted([(2, "a b"), (2, "c"), (3, "d"), (None, "a b"), (None, "a b"), (5, ""), (6, "e")], key=str)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("strategy=merge") >= 1


def test_a_family_is_compared_where_its_lists_lie(spark):
    # Every text differs from the others in words of its own: the first one is like few, and no list tells who is linked.
    words = [f"w{i}" for i in range(120)]
    own = {d: [f"o{d}" if 3 <= (i * 7 + d) % 120 < 5 + d % 3 else w for i, w in enumerate(words)] for d in range(60)}
    rows = [(d, " ".join(w)) for d, w in own.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(table, jaccard.Measure(4, 85)).collect()}
    assert found == similar_by_brute_force(rows, 4, 85)


def test_questioned_documents_are_as_many_as_there_are():
    # All pairs of 40 sets that lie in the same 30 lists: documents come back, not pairs of them, and each once.
    measure, rng = jaccard.Measure(), np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**63, 10).astype(np.uint64)])) for _ in range(40)]
    entries = pd.DataFrame(
        [(t, d, len(s), d, 1, 0, 0, 0, jaccard.sketch(s)) for t in range(30) for d, s in enumerate(sets)],
        columns=["token", "doc_id", "n", "component", "blocks", "block", "one", "other", "sketch"],
    )
    assert jaccard._questioned(measure)(entries)["doc_id"].tolist() == list(range(1, 40))
    known = pd.DataFrame({"node": range(40), "component": range(40), "shingles": [s.tobytes() for s in sets]})
    assert len(jaccard._connected(measure)(entries, known)) == 39


def test_language_model_leaves_no_grams_behind(spark):
    table = spark.createDataFrame([(i, f"some words {i} of a text") for i in range(20)], "doc_id long, text string")
    folder = Path(checkpoint_root(spark).removeprefix("file:")) / "linkloom"
    before = set(folder.glob("gram*"))
    assert suffix_tree.suffix_tree_scores(table).count() == 20
    assert set(folder.glob("gram*")) <= before


def test_a_full_cache_keeps_what_is_asked_for_again():
    computed = []
    cache = WordCache(lambda word: computed.append(word) or len(word), most=8)
    for i in range(40):
        assert cache[b"often"] == 5 and cache[str(i).encode()] == len(str(i))
    assert computed.count(b"often") == 1 and len(cache) + len(cache.before) <= 9


def test_required_occurrences_hold_for_all_sizes():
    measure = jaccard.Measure(4, 85)
    for n in range(1, 400):
        for m in range(-(-85 * n // 100), n + 1):
            needed = measure.required(n, m)
            assert 100 * needed >= 85 * (n + m - needed) and (needed == 0 or 100 * (needed - 1) < 85 * (n + m - needed + 1))
            # The first skips + 1 common shingles lie in both listed parts.
            for own, other in ((n, m), (m, n)):
                skip = measure.skips(own)
                if needed > skip:
                    assert skip + 1 + own - needed <= max(measure.listed(own), own if measure.listed(own) == own else 0)
                    assert skip + 1 + other - needed <= measure.listed(other) or measure.listed(other) == other


def test_repeats(docs, texts, nothing, monkeypatch):
    monkeypatch.setattr(repeats, "SENT_PHRASES", 40)
    found = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(docs).where("doc_id IS NOT NULL").collect()}
    seen: set[bytes] = set()
    for i, text in sorted({(i, t) for i, t in texts if i is not None}):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if data[at : at + 100] in seen:
                gone[at : at + 100] = b"\x01" * 100
            seen.add(data[at : at + 100])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        assert found[i] == (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()), i
    assert any(v[1] for v in found.values())
    assert repeats.remove_repeats(nothing).count() == 0


def test_phrases_of_pieces_equal_those_of_the_whole(monkeypatch):
    rng = random.Random(5)
    data = bytes(rng.choice(b"abcd") for _ in range(3000))
    windows = [(int(s) + k, int(t)) for s, shape, t in zip(*repeats.parse(data), strict=True) for k in range(int(shape) & 255)]
    monkeypatch.setattr(repeats, "PIECE", 1023)
    cut = [(int(s) + k, int(t)) for s, shape, t in zip(*repeats.parse(data), strict=True) for k in range(int(shape) & 255)]
    assert windows == cut and len(windows) == len(data) - 99


def test_suffix_tree_scores(docs, texts, nothing):
    found = sorted(map(tuple, suffix_tree.suffix_tree_scores(docs).where("doc_id IS NOT NULL").collect()))
    tokens = lambda text: [*(text or "").encode().lower().split(), b" "]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in texts if i is not None and not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted((i, held(i), tokens(t)) for i, t in texts if i is not None)
    for row, (i, out, words) in zip(found, expected, strict=True):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert row[:5] == (i, out, len(words), sum(counts[w] > 0 for w in words), total)
        assert row[5] == pytest.approx(base) and row[6] < 0
    assert suffix_tree.suffix_tree_scores(nothing).count() == 0


def test_suffix_tree_probabilities_add_up():
    states = [(b"", {97: 5, 98: 3, 0: 2}), (b"a", {97: 1, 98: 6}), (b"aa", {98: 4}), (b"\x00", {97: 9})]
    tree = suffix_tree.SuffixTree(states)
    assert sum(tree.probability(b"", s) for s in range(257)) == pytest.approx(1, abs=0.3)
    assert tree.probability(b"xaa", 98) > tree.probability(b"xa", 98) > tree.probability(b"x", 98)
    assert tree.word_log10(b"ab") > tree.word_log10(b"ba") > tree.word_log10(b"zz")


def brute_scores(texts, held):
    """Log10 scores of ``texts`` by all contexts of the training texts, through the plain tree."""
    depth = suffix_tree.DEPTH
    running = [b"\n" * depth + b" ".join((t or "").encode().lower().split()) + b"\n" for _, t in texts]
    next_of: dict[bytes, Counter] = {}
    for (i, _), data in zip(texts, running, strict=True):
        for at in range(depth, len(data) if not held(i) else 0):
            for low in range(at - depth, at + 1):
                next_of.setdefault(data[low:at], Counter())[data[at]] += 1
    states = [(b"", dict(next_of[b""]))]
    for context, counts in next_of.items():
        if context:
            shorter, total = next_of[context[1:]], sum(counts.values())
            under = sum(shorter.values())
            if sum(n * math.log(n / total / (shorter[s] / under)) for s, n in counts.items()) >= suffix_tree.LEAST_GAIN:
                states.append((context, dict(counts)))
    tree = suffix_tree.SuffixTree(states)
    score = lambda d: sum(math.log10(tree.probability(d[at - depth : at], d[at])) for at in range(depth, len(d)))
    return [score(data) for data in running], len(states)


@pytest.mark.parametrize("gain", (60.0, 0.5))
def test_every_context_that_diverges_counts(docs, texts, monkeypatch, gain):
    monkeypatch.setattr(suffix_tree, "LEAST_GAIN", gain)
    monkeypatch.setattr(suffix_tree, "SLICE_LETTERS", 500)
    monkeypatch.setattr(suffix_tree, "MOST_STATES", 3, raising=False)
    expected, states = brute_scores(texts, lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2)
    found = [(r["doc_id"], r["score"]) for r in suffix_tree.suffix_tree_scores(docs).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    wanted = sorted(((i, s) for (i, _), s in zip(texts, expected, strict=True)), key=order)
    assert states > 10 and len(found) == len(wanted)
    for (i, score), (j, right) in zip(sorted(found, key=order), wanted, strict=True):
        assert i == j and score == pytest.approx(right)


def test_order_and_unseen_words_change_the_score(spark):
    train = [(i, "the cat sat on the mat and the dog lay by the door " * 20) for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    asked = ["the cat sat on the mat", "mat the on sat cat the", "the cat sat on the catdog", "the cat sat on the xqzvjk"]
    frame = spark.createDataFrame([*train, *((None, t) for t in asked)], "doc_id long, text string")
    rows = suffix_tree.suffix_tree_scores(frame).where("doc_id IS NULL").collect()
    bases, scores = sorted(r["base_score"] for r in rows), sorted(r["score"] for r in rows)
    right, _ = brute_scores([*train, *((None, t) for t in asked)], lambda i: i is None)
    assert scores == pytest.approx(sorted(right[-4:])) and bases[0] == pytest.approx(bases[1]) and bases[2] == pytest.approx(bases[3])
    same_words, shuffled, like_seen, unlike = right[-4:]
    assert same_words > shuffled + 1 and like_seen > unlike + 1


def test_decontamination(spark, docs, nothing):
    rng = random.Random(9)
    item = [f"w{k}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (4, "")], "item_id long, text string")
    cases = {}
    for k in range(60):
        size = rng.choice((5, 13, 20, 40))
        low = rng.randrange(0, 41 - size)
        part = item[low : low + size]
        for at in rng.sample(range(size), rng.randrange(0, size // 2)):
            part[at] = f"x{at}"
        cases[k] = [f"f{rng.randrange(99)}" for _ in range(rng.randrange(30))] + part + [f"g{rng.randrange(99)}" for _ in range(9)]
    frame = spark.createDataFrame([(k, " ".join(w).upper(), 1) for k, w in cases.items()], "doc_id long, text string, item_id int")
    found = {(r["doc_id"], r["item_id"]): r["n_agree"] for r in decontaminate.contaminated(frame, items).collect()}
    expected = {}
    for k, words in cases.items():
        for offset in range(-40, len(words)):
            same = [0 <= offset + j < len(words) and words[offset + j] == item[j] for j in range(40)]
            low, high = max(0, -offset), min(40, len(words) - offset)
            window = max((sum(same[j : j + 13]) for j in range(low, high - 12)), default=0)
            if sum(same) >= 32 or window >= 0.8 * 13:
                expected[k, 1] = max(expected.get((k, 1), 0), sum(same))
    assert found == expected and 0 < len(expected) < len(cases)
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def _peak(run, frame: pa.RecordBatch) -> tuple[list[pa.RecordBatch], int]:
    """What a worker's function makes of one batch, and the most bytes it held meanwhile."""
    tracemalloc.start()
    try:
        found = [x for x in run(iter([frame])) if x.num_rows]
        return found, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_worker_holds_a_portion_of_its_batch_at_once():
    text = " ".join(f"w{k % 97}" for k in range(400))
    item = " ".join(f"w{k}" for k in range(20, 60))
    texts = [text.encode()] * 6_000 + [b"", item.encode() * 3]
    ids = pa.array(range(len(texts)), pa.int64())
    frame = pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.binary())], ["doc_id", "text"])
    found, peak = _peak(decontaminate._search(decontaminate.SeedIndex([(7, item.encode())])), frame)
    assert [x for f in found for x in f.column("doc_id").to_pylist()] == [*range(6_000), 6_001]
    assert peak < 40 * PORTION_BYTES

    packed, peak = _peak(jaccard._compressed, frame.rename_columns(["doc_id", "data"]))
    assert sum(x.num_rows for x in packed) == len(texts) and peak < 6 * PORTION_BYTES


def _workers(plan) -> list[int]:
    """Python nodes of each stage of a physical plan, the stage of its root first."""
    children = plan.children()
    below = [_workers(children.apply(i)) for i in range(children.size())]
    ended = [n for stages in below for n in stages[1:]]
    here = sum(stages[0] for stages in below)
    name = plan.nodeName()
    if "Exchange" in name:
        return [0, here, *ended]
    return [here + ("InPandas" in name or "InArrow" in name), *ended]


def test_no_task_of_the_pipeline_runs_two_python_workers(spark, docs, monkeypatch):
    plans = []

    def recorded(df, name):
        plans.append((name, max(_workers(df._jdf.queryExecution().executedPlan()))))
        return stage_table(df, name)

    for module in (exact_dedup, jaccard):
        monkeypatch.setattr(module, "staged", recorded)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for step in (exact_dedup.drop_copies, jaccard.drop_near_copies):
            recorded(step(docs), step.__name__)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(plans) > 10 and [name for name, n in plans if n > 1] == []


def test_every_tolerated_window_has_a_seed():
    for wrong in itertools.combinations(range(13), 2):
        good = [k not in wrong for k in range(13)]
        assert any(all(good[at + o] for o in mask) for mask in decontaminate.MASKS for at in range(13 - mask[-1]))


def test_pieces_agree_with_the_public_library(docs, texts, nothing):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECE_MODEL)
    samples = [t for _, t in texts if t is not None] + ["Hello  world\nabc ☃ é", "    a    b", "日本語 😀", "x\x00<s>", "aaaaaa" * 9]
    with open(PIECE_MODEL, "rb") as file:
        transducer = pieces.PieceTransducer(file.read())
    for text in samples:
        ids = np.frombuffer(transducer.encode(text), "<i4").tolist()
        assert ids == library.encode(text) and transducer.decode(ids) == text
    rows = pieces.tokenised(docs, PIECE_MODEL).collect()
    assert all(r["round_trip"] for r in rows if r["piece_ids"] is not None)
    assert sum(r["piece_ids"] is None for r in rows) == sum(t is None for _, t in texts)
    assert pieces.tokenised(nothing, PIECE_MODEL).count() == 0


def test_unigram_path_is_the_cheapest():
    def field(number: int, payload: bytes) -> bytes:
        return bytes([number << 3 | 2, len(payload)]) + payload

    vocabulary = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "▁a": -4.0, "ba": -2.8, "▁ab": -6.5}
    model = b"".join(field(1, field(1, p.encode()) + b"\x15" + np.float32(s).tobytes()) for p, s in vocabulary.items())
    transducer = pieces.PieceTransducer(model + field(2, b"\x18\x01") + field(3, b"\x18\x01\x20\x00"))

    def cheapest(word: str) -> float:
        if not word:
            return 0.0
        return min((cheapest(word[len(p) :]) - s for p, s in vocabulary.items() if word.startswith(p)), default=math.inf)

    for letters in itertools.product("ab", repeat=5):
        word = "▁" + "".join(letters)
        path = transducer.shortest_path(word)
        assert "".join(path) == word and sum(-vocabulary[p] for p in path) == pytest.approx(cheapest(word))


def test_language_identification(spark, docs, nothing):
    rng = random.Random(2)
    syllables = {"aa": "ka lo mi ta ru sen".split(), "bb": "zu pre gli vox dja".split()}
    word = lambda lang: "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4)))
    rows = [(k, " ".join(word(l) for _ in range(30)), l) for k, l in enumerate(["aa", "bb"] * 40)]
    frame = spark.createDataFrame([*rows, (900, "123 ...", "aa"), (901, None, "bb"), (902, "", None)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in languages.language_id(frame).collect()}
    held = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert held and all(found[k]["lang_pred"] == lang for k, _, lang in rows)
    assert all(found[k]["held_out"] == (k in held) for k, _, _ in rows)
    assert {found[k]["lang_pred"] for k in (900, 901, 902)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert languages.language_id(docs).count() == docs.count()
    assert languages.language_id(nothing).count() == 0


def test_phrase_counts_by_brute_force():
    rng = random.Random(4)
    sample = "".join(rng.choice("abc") for _ in range(60))
    automaton = languages.SuffixAutomaton(sample)
    for _ in range(200):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 15)))
        at = count = 0
        while at < len(word):
            end = at + 1
            while end <= len(word) and word[at:end] in sample:
                end += 1
            at = max(at + 1, end - 1)
            count += 1
        assert automaton.phrases(word) == count, word


def test_toxicity(spark, docs, nothing):
    rng = random.Random(8)
    insults = ("blockhead", "numbskull", "wretch")
    rows, labels = [], []
    for k in range(400):
        words = prose(rng, 40).split()
        toxic = k % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(insults)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    frame = spark.createDataFrame([*rows, (990, None), (991, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (991, None), (None, 1), (4, 1)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.toxicity(frame, marks).collect()}
    assert all(found[k]["predicted"] == toxic for k, toxic in labels)
    assert found[990]["predicted"] == found[991]["predicted"] == 0
    model = toxicity.train(*toxicity.labelled_sample(frame, marks))
    assert model.margin("block-head") > max(model.margin(w) for w in ("meadows3", "river1", "blocks"))
    kept = toxicity.drop_toxic(frame, marks)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*(k for k, t in labels if not t), 990, 991]
    assert toxicity.toxicity(docs, marks.limit(0)).count() == docs.count()
    assert toxicity.toxicity(nothing, marks).count() == 0


def test_spelled_out_letters_make_a_word():
    assert "widget" in toxicity.words_of("there W i d g e t there")
    pieces_of = toxicity.words_of("x" * 500 + "widget" + "y" * 500)
    assert any("widget" in p for p in pieces_of) and max(map(len, pieces_of)) <= toxicity.LONGEST


def test_license_scan(spark, docs, nothing):
    body = licenses.LICENCES["MIT"]
    rows = [
        (1, body),
        (2, "Copyright (c) 2001 Some Body\nAll rights reserved.\n\n" + body.upper().replace(".", " . ")),
        (3, body.replace("sublicense", "sub-licence").replace("Software", "software;")),
        (4, body + " extra"),
        (5, None),
        (6, ""),
        (None, "spdx-licence-identifier: MIT"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.license_scan(frame).collect()}
    assert found == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None, None: "SPDX MIT"}
    documents = frame.toPandas()
    same = duckdb.sql(licenses.oracle().replace("FROM documents", "FROM documents")).fetchall()
    spark_rows = [tuple(r) for r in licenses.license_scan(frame).collect()]
    assert Counter((None if i is None or i != i else int(i), d, n) for i, d, n in same) == Counter(spark_rows)
    assert len(documents) == len(rows)
    assert licenses.license_scan(docs).count() == docs.count()
    assert licenses.license_scan(nothing).count() == 0


@pytest.mark.parametrize("name", licenses.LICENCES)
def test_wrapped_licences_keep_their_text(spark, name):
    body = licenses.LICENCES[name]
    heads = ("", "Copyright (c) 2001 Some Body\nAll rights reserved.\n\n", "Copyright Some Body and others.\n\n", "\n(C) 1999, 2003 A. B.\n")
    rows = [(k, head + textwrap.fill(body, width, break_long_words=False)) for k, (head, width) in enumerate(itertools.product(heads, (20, 48, 60, 72, 79, 100)))]
    starts = [f"{word} {rest}" for word, _, rest in (body[m.start() :].partition(" ") for m in re.finditer("(?i)copyright", body))]
    rows += [(100 + k, body[: -len(s)] + "\n" + s) for k, s in enumerate(starts)]
    found = {r["doc_id"]: r["license"] for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {k: name for k, _ in rows}
    kept = spark.createDataFrame([(body,)], "text string").select(licenses.canonical(F.col("text"))).first()[0]
    assert kept.count("copyright") == body.lower().count("copyright")


def test_shipped_licences_and_titles(spark):
    texts = list(licenses.licence_texts())
    assert {"GPL-2", "GPL-3", "LGPL-2.1", "MPL-2.0", "Apache-2.0", "BSD-3-Clause"} <= {name for name, _ in texts}
    known = licenses.shipped_digests(spark).cache()
    rows = [(k, "Copyright (c) 2001 Some Body\n\n" + body) for k, (_, body) in enumerate(texts)]
    rows.append((-1, "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + textwrap.fill(licenses.LICENCES["MIT"], 70)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.license_scan(frame, known).collect()}
    assert found == {-1: "MIT"} | {k: name for k, (name, _) in enumerate(texts)}


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now.</div>
<article><h1>{title}</h1><p><b>{first}<br><p>{second} &amp; &eacute;&#x41;.</p></article><footer>&copy; site</footer></body></html>"""


def test_main_text(spark, nothing):
    rng = random.Random(6)
    rows, expected = [], {}
    for k in range(80):
        title, first, second = prose(rng, 5), prose(rng, 30), prose(rng, 25)
        rows.append((k, f"http://h/{k}", PAGE.format(title=title, first=first, second=second), "x"))
        expected[k] = f"{title} {first} {second} & éA."
    rows += [(900, None, None, None), (901, "u", "", None), (None, "u", "<<<>><p", None), (902, "u", "<p a='" * 2000, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.main_text(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["page_id"] in expected:
            assert row["text"] == expected[row["page_id"]] and row["n_chars"] == len(row["text"])
        elif row["page_id"] in (900, 901):
            assert row["text"] == "" and row["n_chars"] == 0
    empty = pages.limit(0)
    assert html_text.main_text(empty).count() == 0


def test_labeller_gradients():
    rng = np.random.default_rng(0)
    labeller = html_text.BlockLabeller(1)
    labeller.weights = {k: w.astype(np.float64) for k, w in labeller.weights.items()}
    x, mask = html_text.padded([rng.normal(size=(n, html_text.WIDTH)).astype(np.float32) for n in (3, 5)])
    y = (rng.random(mask.shape) > 0.5).astype(np.float32)
    _, grads = labeller.gradients(x, mask, y)
    for key, at in (("fx", (3, 5)), ("fh", (2, 7)), ("bh", (1, 60)), ("bc", (20,)), ("o", (4,))):
        weight = labeller.weights[key]
        kept, losses = weight[at], []
        for step in (1e-3, -1e-3):
            weight[at] = kept + step
            losses.append(labeller.gradients(x, mask, y)[0])
        weight[at] = kept
        assert grads[key][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-4)
