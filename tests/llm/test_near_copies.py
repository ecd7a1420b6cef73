"""Jaccard components and repeated passages against brute force."""

import hashlib
import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from sparkmine.llm import parity, repeats
from sparkmine.llm.words import split_words, text_slices, words_of

SCHEMA = "doc_id bigint, text string, node string, key bigint, lo int"


def _words(n, seed, size=5000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def _edited(words, edits, seed):
    rng, out = random.Random(seed), list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**9)}"
    return out


def _rows():
    """Families of copies with 0 to 12 edits, exact copies, short, blank and missing texts, and a repeated row."""
    texts = []
    for family, length in enumerate([12, 40, 150, 400]):
        base = _words(length, family)
        texts += [" ".join(_edited(base, i % 13 if length > 12 else i % 3, 100 * family + i)) for i in range(40)]
    texts += [texts[50]] * 15 + ["One two", "ONE  two", "one", "", "  \n ", None, "Été one two three", "été one two three"]
    order = random.Random(5).sample(range(len(texts)), len(texts))
    rows = [(i, texts[j], "x", None, 1) for i, j in enumerate(order)]
    return [*rows, rows[3], (None, texts[50], None, 1, None), (None, None, None, None, None)]


def _set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _components(rows, k, num, den):
    sets = {d: _set(t, k) for d, t, *_ in rows if d is not None}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((d, len(_set(t, k)), None if d is None else find(d)) for d, t, *_ in rows if d is not None)


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100)])
def test_components(spark, k, num, den):
    rows = _rows()
    got = parity.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(7), parity.Rule(k, num, den)).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == _components(rows, k, num, den)
    assert all(r.component_id is None for r in got if r.doc_id is None)


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = parity.keep_one(docs, parity.Rule())
    assert kept.columns == docs.columns
    heads = {c for d, _, c in _components(rows, 5, 80, 100)}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == heads


def test_sketch_distance_never_exceeds_the_difference():
    rule = parity.Rule(4, 85, 100)
    bands = rule.bands(1000)
    assert [low for low, _, _ in bands][:4] == [1, 2, 3, 4]
    base = np.unique(np.random.default_rng(1).integers(0, 2**63, 400, dtype=np.uint64))
    for gone in (1, 20, 60):
        a, b = base, base[gone:]
        if 100 * len(b) >= 85 * len(a):
            assert set(parity.sketch_pieces(rule, bands, a)) & set(parity.sketch_pieces(rule, bands, b))


def test_no_link_is_lost_when_the_first_of_every_group_goes(spark, monkeypatch):
    """Every piece that two linked texts share is led by another text, which meets them in that piece only and so is dropped."""
    rule, rng = parity.Rule(4, 85, 100), random.Random(12)

    def node(text):
        ((_, (found,)),) = parity._sets(rule, pa.array([text]))
        return parity._node(found)

    base = [f"b{i}" for i in range(66)]
    pair = [" ".join(base), " ".join(["p", *base[1:-4], "q", "r", "s", "t"])]
    strangers = [" ".join(f"z{rng.randrange(10**6)}" for _ in range(66)) for _ in range(600)]
    strangers = [t for t in strangers if node(t) < min(map(node, pair))][:8]
    assert len(strangers) == 8
    held = [(key, node(t)) for key, stranger in enumerate(strangers) for t in [stranger, *pair]]
    held += [(100 + i, node(t)) for i, t in enumerate([*strangers, *pair])]
    monkeypatch.setattr(parity, "_pieces", lambda docs, rule: spark.createDataFrame(held, "key bigint, node bigint"))
    rows = [(i, t, None, None, None) for i, t in enumerate([*pair, *strangers])]
    got = parity.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3), rule).collect()
    assert sorted(tuple(r) for r in got) == _components(rows, 4, 85, 100)
    assert {r.component_id for r in got if r.doc_id < 2} == {0}


def test_clashing_names_in_keep_one(spark):
    rows = [(1, "a b c d e f", 1, 2, 3), (2, "a b c d e f", 1, 2, 3), (3, None, 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone int, _gone int, head int")
    kept = parity.keep_one(docs, parity.Rule())
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3}


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert parity.jaccard_components(none, parity.Rule()).count() == 0
    assert repeats.without_repeats(none).count() == 0


def _without(rows, window):
    low, out = {}, []
    for d, t, *_ in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            if d is not None:
                low[tuple(w[i : i + window])] = min(d, low.get(tuple(w[i : i + window]), d))
    for d, t, *_ in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and low[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeated_passages(spark):
    rng = random.Random(2)
    passages = [_words(n, 90 + n) for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(4)):
            words += _words(rng.randrange(60), i * 7 + len(words)) + rng.choice(passages)[rng.choice([0, 0, 3]) :]
        rows.append((i, " \n".join(words), None, 1, 1))
    rows += [(200, " ".join(["a"] * 300), "x", 1, 1), (201, " ".join(["a"] * 70), "x", 1, 1), (202, None, "x", 1, 1), (203, "", None, None, None)]
    rows += [rows[5], rows[5], (None, rows[7][1], None, None, None)]
    got = repeats.digest(repeats.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == _without(rows, repeats.WINDOW)


def test_words_split_at_ascii_white_space_only():
    text = "A b\tC\x0b\x1cd  é\n"
    words = words_of(text, lower=True)
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)] == ["a b", "c", "\x1cd", "é"]
    parts = [split_words(d, b).counts().tolist() for _, _, d, b in text_slices(pa.array(["a b", None, "c" * 9, "", "d e f"]), limit=4)]
    assert sum(parts, []) == [2, 0, 1, 0, 3]


def test_a_batch_of_texts_needs_little_memory():
    """Working memory follows a slice, not the batch, and the sets do not depend on the slices."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in row) for row in rng.integers(0, 9000, (1500, 400)).tolist()]
    column, rule = pa.array([*texts, None, "", "one"]), parity.Rule()
    alone = {i: next(parity._sets(rule, column.slice(i, 1)))[1][0].tolist() for i in range(0, len(column), 50)}
    tracemalloc.start()
    before, seen = tracemalloc.get_traced_memory()[0], 0
    for at, sets in parity._sets(rule, column):
        assert at == seen
        assert all(sets[i - at].tolist() == s for i, s in alone.items() if at <= i < at + len(sets))
        seen += len(sets)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert seen == len(column) and column.nbytes > 3e6
    assert peak < 30e6, peak
