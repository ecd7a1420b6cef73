"""Decontamination, personal data, token counts, scores, licenses, rules, mixing and archives on small tables."""

import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmine.llm import archives, decontam, hosts, licenses, mixing, pii, pseudo, transducer
from sparkmine.llm.queries import _tokenizer
from sparkmine.llm.words import text_slices, words_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, position string, node int"


def _docs(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", sources[i] if sources else "s", 1, "p", 2) for i, t in enumerate(texts)], DOCS)


def _sentence(n, seed):
    rng = random.Random(seed)
    return [f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(n)]


def test_contaminated_finds_copies_and_leaves_clean_texts(spark):
    items = [" ".join(_sentence(30, 1)), " ".join(_sentence(45, 2)), "tiny item", "", None]
    words = items[0].split()
    edited = [w for i, w in enumerate(words) if i not in (7, 20)]
    edited[12] = "changed"
    texts = [" ".join([*_sentence(40, 50 + i), *part, *_sentence(40, 80 + i)]) for i, part in enumerate([words, edited, words[:8], [], items[1].upper().split()])]
    texts += [items[0], "a tiny item here", None, "", " ".join(words * 3)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.contaminated(_docs(spark, texts), benchmark).collect()}
    assert set(found) == {(0, 0), (1, 0), (4, 1), (5, 0), (6, 2), (9, 0)}
    assert found[0, 0].score == 1 and (found[0, 0].first_word, found[0, 0].last_word) == (40, 69)
    assert 0.8 < found[1, 0].score < 1
    left = decontam.without_contaminated(_docs(spark, texts), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 7, 8] and left.columns == _docs(spark, texts).columns
    assert decontam.contaminated(_docs(spark, texts), benchmark.limit(0)).count() == 0
    assert decontam.contaminated(_docs(spark, []), benchmark).count() == 0


def _plain_align(a, b):
    best, table = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
            best = max(best, table[i + 1, j + 1])
    return best


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a = rng.integers(1, 6, rng.integers(1, 15)).astype(np.uint64)
        rows = rng.integers(1, 6, (4, rng.integers(1, 25))).astype(np.uint64)
        assert decontam.align(a, rows)[0].tolist() == [_plain_align(a, r) for r in rows]


def test_copies_that_open_inside_an_item_are_found_in_any_row_order(spark):
    item = _sentence(30, 5)
    texts = [" ".join([*item[k:], *_sentence(20, 200 + k)]) for k in (1, 2, 5)] + [" ".join(_sentence(40, 300 + i)) for i in range(3)]
    benchmark = spark.createDataFrame([(0, " ".join(item))], "item_id bigint, text string")
    for order in ([3, 0, 4, 1, 5, 2], [0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0]):
        docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id bigint, text string").coalesce(1)
        found = {r.doc_id: (r.score, r.first_word, r.last_word) for r in decontam.contaminated(docs, benchmark).collect()}
        assert found == {i: ((30 - k) / 30, 0, 29 - k) for i, k in enumerate((1, 2, 5))}


def test_edited_copies_equal_the_full_alignment(spark):
    items = [_sentence(12 if i % 5 == 4 else 30, 400 + i) for i in range(24)]  # one copy of each
    items[2][:3] = items[0][:3]  # a gram that items share
    texts = []
    for i, item in enumerate(items):
        rng, half = random.Random(i), len(item) // 2
        if i % 4 == 0:
            texts.append([w for j, w in enumerate(item, 1) for w in ([w, f"new{j}"] if j % 3 == 0 else [w])])
        elif i % 4 == 1:
            texts.append([f"new{j}" if j % 4 == 0 else w for j, w in enumerate(item, 1)])
        elif i % 4 == 2:
            texts.append([*item[:half], *[f"new{j}" for j in range(half)], *item[half:]])
        else:
            texts.append([f"new{j}" if rng.random() < 0.2 else w for j, w in enumerate(item)])
    texts = [[*_sentence(15, 500 + i), *text, *_sentence(15, 600 + i)] for i, text in enumerate(texts)]
    texts += [items[0][:3] * 20, _sentence(60, 700), [w for j, w in enumerate(items[0], 1) for w in ([w, f"new{j}"] if j % 2 == 0 else [w])]]
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(_docs(spark, [" ".join(t) for t in texts]), benchmark).collect()}
    scores = {(d, i): _plain_align(item, text) / (2 * len(item)) for d, text in enumerate(texts) for i, item in enumerate(items)}
    assert found == {k: s for k, s in scores.items() if s >= 0.6}
    assert {(0, 0), (1, 1), (2, 2), (len(texts) - 1, 0)} <= set(found)
    sent = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(_docs(spark, [" ".join(t) for t in texts]), benchmark, broadcast_bytes=0).collect()}
    assert sent == found  # joins above the broadcast limit


def test_copies_of_common_words_are_found_by_the_rarest_seeds(spark, monkeypatch):
    """Items and texts over few words, nothing rare: recall against the full alignment without any condition."""
    monkeypatch.setattr(decontam, "FEW", 0)
    monkeypatch.setattr(decontam, "RARE", 0.0)
    rng = random.Random(9)
    items = [[f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(rng.randrange(16, 50))] for _ in range(20)]
    texts = []
    for d in range(120):
        share = rng.uniform(0.15, 0.25)
        copy = [x for w in items[d % 20] for x in rng.choice([[w], [f"n{rng.randrange(400)}"], [w, "the"], []] if rng.random() < share else [[w]])]
        texts.append([*_sentence(rng.randrange(20), d), *copy, *_sentence(rng.randrange(20), 900 + d)])
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(_docs(spark, [" ".join(t) for t in texts]), benchmark).collect()}
    scores = {(d, i): _plain_align(item, text) / (2 * len(item)) for d, text in enumerate(texts) for i, item in enumerate(items)}
    true = {k: s for k, s in scores.items() if s >= 0.6}
    assert len(true) > 80 and found.items() <= true.items() and len(found) >= 0.9 * len(true)


def test_repeated_items_and_texts_and_rows_without_ids(spark):
    item = " ".join(_sentence(20, 31))
    benchmark = spark.createDataFrame([(1, item), (1, item), (None, item), (2, "word"), (3, None), (4, " ")], "item_id bigint, text string")
    docs = spark.createDataFrame([(7, item), (7, item), (None, f"x {item}"), (8, "a WORD\n"), (9, None), (10, "")], "doc_id bigint, text string")
    found = sorted((str(r.doc_id), str(r.item_id), r.first_word, r.last_word) for r in decontam.contaminated(docs, benchmark).collect())
    of_seven = [("7", i, 0, 19) for i in ("1", "1", "None")]
    assert found == sorted([*of_seven, *of_seven, ("8", "2", 1, 1), *[("None", i, 1, 20) for i in ("1", "1", "None")]])
    assert sorted(str(r.doc_id) for r in decontam.without_contaminated(docs, benchmark).collect()) == ["10", "9", "None"]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and pii._luhn(re.sub(r"\D", "", m)),
        "phone": lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text) if ok[k](m.group())] for k, p in PATTERNS.items()}


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    fixed = ["a@b.c_d@e.f.", "@a.b", "x@y", "a@b@c.d", "1.2.3.4.5.6.7.8", "300.1.1.1 0255.1.1.1", "+1 (234) 555-6789 +12", "4111 1111-1111 1111 2", "++49 30 1234567.", "éa@b.c ١"]
    texts = fixed + ["".join(rng.choice("01259.@+- ()aB_%é") for _ in range(rng.randrange(80))) for _ in range(4000)]
    for text in texts:
        assert pii.base_spans(text) == _plain_spans(text), text


def _private(n, seed):
    rng = random.Random(seed)

    def number(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    out = []
    for _ in range(n):
        card = next(c for c in (("4" + number(15)) for _ in iter(int, 1)) if pii._luhn(c))
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        made = rng.choice([f"+1 ({number(3)}) 555-{number(4)}", card, ip, f"{rng.choice('abc')}{number(2)}@mail{number(1)}.org", f"order {number(6)}", f"in {number(4)}"])
        out.append(" ".join([*_sentence(3, seed + rng.randrange(9**9)), made, "of", "the", "text"]))
    return out


def test_tagger_on_held_out_texts():
    codes, tags = pii.training_windows(_private(pii.TRAIN_TEXTS, 10))
    tagger = pii.Tagger.fresh(0).train(codes, tags)
    right = total = 0
    for text in _private(120, 77):
        for start in pii.window_starts(text):
            found, sure = tagger.decode(pii._window(pii.encode(text), start)[None])
            got = {p[:3] for p in pii._proposals(found[0], sure[0], start, len(text))}
            spans = {(a, b, k) for k, v in pii.base_spans(text).items() for a, b in v if start <= a and b <= start + pii.WIDTH - 1 and (a > start or start == 0)}
            right, total = right + len(spans & got), total + len(spans)
    assert right >= 0.8 * total > 0


def test_personal_data_edges(spark):
    texts = [None, "", "mail a.b@c.org!", "x" * 30_000 + " 10.0.0.1 " + "y" * 30_000, "clean text"]
    docs = _docs(spark, texts)
    rows = {r.doc_id: r for r in pii.personal_data(docs, None).collect()}
    assert rows[2].spans == "email:5:14" and rows[3].n_ip == 1 and rows[0].spans == rows[1].spans == ""
    masked = {r.doc_id: r for r in pii.redact(docs, None).collect()}
    assert masked[0].text is None and masked[2].text == "mail [email]!" and masked[4].text == "clean text"
    assert pii.redact(docs, None).schema == docs.schema
    assert pii.train_tagger(_docs(spark, ["no digits", None])) is None


def test_reconcile_takes_the_best_set():
    assert pii.reconcile([(0, 10, "ip", 0.9), (8, 20, "card", 0.9), (10, 30, "phone", 0.9)]) == [(0, 10, "ip"), (10, 30, "phone")]


class _Proposer:
    """In place of a tagger: every run of digits in a window is a phone, so that a text has as many proposals as numbers."""

    def decode(self, windows):
        digit = np.isin(windows, pii.encode("0123456789"))
        first = digit & ~np.concatenate((np.zeros((len(digit), 1), bool), digit[:, :-1]), axis=1)
        begin = 1 + 2 * pii.KINDS.index("phone")
        return np.where(first, begin, np.where(digit, begin + 1, 0)), np.ones(windows.shape)


def test_spans_of_a_text_full_of_numbers_take_linear_time_and_overlap_no_base_span():
    line = "call 0170 5551234567 or 10.0.0.1 or +49 170 5551234567\n"
    seconds = []
    for n in (1000, 8000):
        at = time.perf_counter()
        base, spans = pii.find_spans([line * n], _Proposer())[0]
        seconds.append(time.perf_counter() - at)
        assert len(base["phone"]) == len(base["ip"]) == n and len(spans["phone"]) == 2 * n
        every = sorted(s for found in spans.values() for s in found)
        assert all(b <= c for (_, b), (c, _) in zip(every, every[1:]))
    assert seconds[1] < 8 * 2.5 * seconds[0]


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = _tokenizer("word_bpe_49k.json")
    rng = random.Random(8)
    letters = "abcdeghilnorstuvABC'!?-.,019 \n\t\xa0\x85éÀß²$|"
    texts = ["", None, "don't I'LL we've ''s x's's rock'n'roll", "a<|endoftext|>b <|startoftext|>", "naïve 日本 é İ", "x" * 5000, "'"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(400)]
    expected = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    rows = sorted(transducer.token_counts(_docs(spark, texts).repartition(3), path).collect())
    assert [r.n_tokens for r in rows] == expected
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in texts]


def test_a_bounded_table_gives_the_same_counts(monkeypatch):
    spec = open(_tokenizer("word_bpe_49k.json"), encoding="utf-8").read()
    column = pa.array([" ".join(_sentence(50, i)) for i in range(20)])
    first = [transducer.count_tokens(spec, d, b).tolist() for _, _, d, b in text_slices(column)]
    monkeypatch.setattr(transducer, "MOST_TRANSITIONS", 10)
    assert [transducer.count_tokens(spec, d, b).tolist() for _, _, d, b in text_slices(column)] == first


def test_license_scan_of_wrapped_headers_and_a_long_line(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    mpl = "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy"
    narrow = "\n * ".join("Permission is hereby granted, free of charge, to any person obtaining a copy of this software".split())
    far = " ".join(w for part in ("released", "under", "the", "license") for w in [part, *_sentence(500, len(part))])
    two = "Released under the MIT license.\nThis work is licensed under the GNU General\nPublic License version 3"
    rows = sorted(licenses.scan(_docs(spark, [bsd, mpl, narrow, far, two, " ".join([far, bsd])])).collect())
    assert [r.labels for r in rows] == ["bsd", "mpl-2", "mit", "", "gpl-3,mit", "bsd"]
    assert [r.score for r in rows] == [1, 1, 1, 0, 1, 1]


def _license_blocks(text):
    """Labels and best score of one text by the written rule, place by place."""
    words = [w for w in re.split("[^0-9a-z\x80-\U0010ffff]+", text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))) if w]
    met = []
    for label, sentence in licenses.TEMPLATES:
        own, width = set(sentence.split()), 2 * len(sentence.split())
        for i, w in enumerate(words):
            firsts = {}
            for j in range(i, min(i + width, len(words))):
                if w in own and words[j] in own:
                    firsts.setdefault(words[j], j)
            if len(firsts) >= np.ceil(licenses.THRESHOLD * len(own) - 1e-9) and w not in words[i + 1 : max(firsts.values()) + 1]:
                met.append((len(firsts) / len(own), i, max(firsts.values()), label))
    good = [m for m in met if not any(b[0] > m[0] and b[1] <= m[2] and b[2] >= m[1] for b in met)]
    return {m[3] for m in good}, max((m[0] for m in good), default=0.0)


def test_license_blocks_against_brute_force(spark):
    rng = random.Random(31)
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 4)):
            part = rng.choice(licenses.TEMPLATES)[1].split()
            part = [w for w in part if rng.random() > 0.1]
            for _ in range(rng.randrange(0, 8)):
                part.insert(rng.randrange(len(part) + 1), rng.choice(["the", "of", "License", "version", "xyz", "software"]))
            words += part + [rng.choice(["the", "filler", "in", "and"])] * rng.randrange(0, 5)
        texts.append(rng.choice([" ", "\n# ", ", "]).join(words))
    rows = {r.doc_id: r for r in licenses.scan(_docs(spark, texts + texts[:20])).collect()}
    for i, text in enumerate(texts + texts[:20]):
        labels, best = _license_blocks(text)
        base = {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in " " + " ".join(re.findall("[0-9a-z]+", text.lower())) + " "}
        assert set(filter(None, rows[i].labels.split(","))) == labels | base, text
        assert rows[i].score == pytest.approx(1.0 if base else best)


def test_long_license_text_takes_time_in_proportion(spark):
    import time

    sentences = " ".join(f"{t}.\n" for _, t in licenses.TEMPLATES)
    begin = time.time()
    row = licenses.scan(_docs(spark, [sentences * (1_000_000 // len(sentences))])).collect()[0]
    assert time.time() - begin < 90 and row.n_words > 100_000 and "gpl-3" in row.labels


def test_pseudo_likelihood_prefers_real_order(spark):
    phrases = [_sentence(6, i) for i in range(6)]
    rng = random.Random(1)
    texts = [" ".join(w for _ in range(60) for w in rng.choice(phrases)) for _ in range(3000)]
    docs = _docs(spark, texts).repartition(2)
    model = pseudo.trained(docs)
    held = [w for _ in range(60) for w in rng.choice(phrases)]
    mixed = rng.sample(held, len(held))
    rows = {r.doc_id: r for r in pseudo.pseudo_likelihood(_docs(spark, [" ".join(held), " ".join(mixed), "", None]), model).collect()}
    assert rows[0].mean_log_prob > rows[1].mean_log_prob + 0.3
    assert rows[2].log_prob == rows[3].log_prob == 0 and rows[2].mean_log_prob is None
    assert pseudo.pseudo_likelihood(_docs(spark, [None])).collect()[0].n_words == 0


def test_pseudo_likelihood_gradient():
    rng = np.random.default_rng(0)
    context, klass = rng.integers(0, pseudo._PAD + 1, (50, 4)), rng.integers(0, pseudo.CLASSES, 50)
    model = pseudo.Adam(pseudo.fresh_weights())
    before = -pseudo.log_class(model.weights, context)[2][np.arange(50), klass].mean()
    for _ in range(40):
        model.learn(context, klass)
    assert -pseudo.log_class(model.weights, context)[2][np.arange(50), klass].mean() < 0.5 * before


def _plain_step(w, first, second, step, context, klass):
    """One step of Adam as the formulas say, a row a place; of the embeddings only the rows of the batch move."""
    n = len(context)
    inputs = w["embed"][context].reshape(n, -1)
    hidden = np.tanh(inputs @ w["in"] + w["in_b"])
    scores = hidden @ w["out"] + w["out_b"]
    d_scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    d_scores /= d_scores.sum(axis=1, keepdims=True)
    d_scores[np.arange(n), klass] -= 1
    d_scores /= n
    d_hidden = (d_scores @ w["out"].T) * (1 - hidden * hidden)
    flat = context.ravel().astype(np.int16)
    order = np.argsort(flat, kind="stable")
    borders = np.flatnonzero(np.diff(flat[order], prepend=-1))
    d_embed = np.add.reduceat((d_hidden @ w["in"].T).reshape(-1, pseudo.EMBED)[order], borders, axis=0)
    grad = {"in": inputs.T @ d_hidden, "in_b": d_hidden.sum(0), "out": hidden.T @ d_scores, "out_b": d_scores.sum(0), "embed": d_embed}
    for k, g in grad.items():
        at = flat[order[borders]] if k == "embed" else slice(None)
        first[k][at] = 0.9 * first[k][at] + 0.1 * g
        second[k][at] = 0.99 * second[k][at] + 0.01 * g * g
        rate = pseudo.RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        w[k][at] -= (rate * first[k][at] / (np.sqrt(second[k][at]) + 1e-8)).astype(np.float32)


def test_a_training_step_equals_the_plain_one_and_is_cheaper():
    from time import perf_counter

    rng = np.random.default_rng(0)
    weights = {k: v + rng.normal(0, 0.3, v.shape).astype(np.float32) for k, v in pseudo.fresh_weights().items()}
    model, plain = pseudo.Adam(weights), {k: v.copy() for k, v in weights.items()}
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    times = []
    for step in range(1, 301):
        context = np.minimum(rng.zipf(1.2, (pseudo.BATCH, 4)) - 1, pseudo._PAD).astype(np.int32)
        klass = rng.integers(0, pseudo.CLASSES, len(context)).astype(np.int32)
        at = [perf_counter()]
        model.learn(context, klass)
        at.append(perf_counter())
        _plain_step(plain, first, second, step, context, klass)
        at.append(perf_counter())
        times.append(np.diff(at))
        if step == 3:  # later on, rounding adds up
            assert all(np.abs(model.weights[k] - plain[k]).max() < 1e-3 for k in plain)
    ours, formulas = np.quantile(times, 0.1, axis=0)
    assert ours < 0.9 * formulas, (ours, formulas)


def test_scores_equal_the_log_probability_of_the_own_class(spark):
    words = words_of(" ".join(_sentence(3000, 5)), lower=True)
    counts = np.bincount(pseudo.buckets(words), minlength=1 << pseudo.BUCKET_BITS)
    vocabulary, weights, rng = pseudo.Vocabulary.of(counts), pseudo.fresh_weights(), np.random.default_rng(0)
    weights = {k: v + rng.normal(0, 1, v.shape).astype(np.float32) for k, v in weights.items()}
    own = pseudo.buckets(words)
    plain = pseudo.log_class(weights, pseudo.contexts(words, vocabulary.row[own]))[2][np.arange(len(own)), vocabulary.klass[own]] + vocabulary.share[own]
    assert np.allclose(pseudo.word_log_probs(words, vocabulary, weights), plain, atol=1e-3)


def test_a_training_step_works_in_kept_arrays():
    """Temporaries of a step stay far below one layer of a batch, 262 KB, so a step's arrays stay in a core's cache."""
    rng = np.random.default_rng(0)
    model = pseudo.Adam(pseudo.fresh_weights())
    context, klass = rng.integers(0, pseudo._PAD + 1, (pseudo.BATCH, 4), np.int32), rng.integers(0, pseudo.CLASSES, pseudo.BATCH, np.int32)
    model.learn(context, klass)
    tracemalloc.start()
    try:
        model.learn(context, klass)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 200_000


@pytest.mark.parametrize("places", [pseudo.BATCH, 3 * pseudo.PIECE, 700, 1])
@pytest.mark.parametrize("scale", [0.1, 5])
def test_gradients_and_scores_of_any_size_equal_the_formulas(places, scale):
    """Whole pieces and others; class scores near 0 and scores beyond the range of exp."""
    rng = np.random.default_rng(places)
    weights = {k: v + rng.normal(0, scale, v.shape).astype(np.float32) for k, v in pseudo.fresh_weights().items()}
    assert pseudo.safe(weights["out"]) == (scale < 1)
    context = np.minimum(rng.zipf(1.2, (places, 4)) - 1, pseudo._PAD).astype(np.int32)
    klass = rng.integers(0, pseudo.CLASSES, places).astype(np.int32)
    model, exact = pseudo.Adam(weights), {k: v.astype(np.float64) for k, v in weights.items()}
    model.learn(context, klass)
    first, second = ({k: np.zeros_like(v) for k, v in exact.items()} for _ in range(2))
    _plain_step({k: v.copy() for k, v in exact.items()}, first, second, 1, context, klass)
    for k, g in {**model.grad, "embed": model.embed[1]}.items():
        assert np.abs(g - 10 * first[k]).max() < 1e-4 * max(1, np.abs(10 * first[k]).max()), k
    words = words_of(" ".join(_sentence(places, 5)), lower=True)
    vocabulary = pseudo.Vocabulary.of(np.bincount(pseudo.buckets(words), minlength=1 << pseudo.BUCKET_BITS))
    own = pseudo.buckets(words)
    expected = pseudo.log_class(exact, pseudo.contexts(words, vocabulary.row[own]))[2][np.arange(places), vocabulary.klass[own]]
    assert np.allclose(pseudo.word_log_probs(words, vocabulary, weights), expected + vocabulary.share[own], rtol=1e-4, atol=1e-3)


def test_chosen_places_do_not_depend_on_the_slice():
    text = " ".join(_sentence(2000, 3))
    assert len(pseudo.chosen_places(words_of(text), 0)) in range(30, 110)


def test_every_word_place_is_learnt(spark, monkeypatch):
    """What a round sums up is weighted by the places seen: all of them."""
    texts = [" ".join(_sentence(n, n)) for n in (1, 7, 300, 2000)] * 3
    docs = _docs(spark, texts).coalesce(1)
    mean = pseudo.shaped(np.zeros(len(pseudo.flat(pseudo.fresh_weights()))))

    def counted(model, kept, seed):  # learns nothing, but counts the places in one weight
        n = sum(len(k) for _, k in kept)
        model.weights["out_b"][0] += n
        return n

    monkeypatch.setattr(pseudo, "_learn", counted)
    vocabulary = pseudo.Vocabulary.of(pseudo.corpus_counts(docs))
    got = pseudo.training_round(docs, vocabulary, mean, 0)
    assert got["out_b"][0] == pytest.approx(sum(len(t.split()) for t in texts))


def test_license_scan(spark):
    texts = ["Released under\nthe MIT License.", "Licensed under CC BY-NC 4.0. cc by nc cc by nc", "the underthe mit license", None, "", "APACHE license, version 2!"]
    texts.append("x\nThis work is licensed under the GNU General Public License, version 3.\ny")
    rows = sorted(licenses.scan(_docs(spark, texts)).collect())
    assert [(r.n_base, r.first_word, r.base_labels) for r in rows] == [(1, 1, "mit"), (3, 2, "cc-by-nc"), (0, None, ""), (0, None, ""), (0, None, ""), (1, 0, "apache-2"), (0, None, "")]
    assert rows[6].labels == "gpl-3" and rows[6].score == 1.0 and rows[3].n_words == 0 and rows[1].last_word == 10
    assert licenses.scan(_docs(spark, [])).count() == 0


def test_host_rules_keep_clean_documents(spark):
    clean, junk = [" ".join(_sentence(60, i)) for i in range(20)], ["# $ % " * 30] * 10
    docs = _docs(spark, [*clean, *junk, None, "short"], ["good"] * 15 + ["bad"] * 5 + ["bad"] * 10 + [None, None])
    rows = {r.doc_id: r for r in hosts.judged(docs).collect()}
    assert [d for d, r in rows.items() if r["__kept"]] and all(rows[d]["__kept"] for d in range(20))
    assert not any(rows[d]["__kept"] for d in range(20, 32))
    kept = hosts.good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 20
    assert hosts.good_documents(docs.limit(0)).count() == 0


def test_mix_targets_and_limits(spark):
    texts = [" ".join(["w"] * n) for n in [50, 60, 10, 10, 300, 200, 5, 0]] + [None, "a b c"]
    docs = _docs(spark, texts, ["a", "a", "b", "b", "c", "c", None, "d", "d", "e"])
    docs = docs.union(docs.where("doc_id = 4"))
    rows = mixing.mix(docs).collect()
    assert len(rows) == 11 and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in rows)
    assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6
    for v in by.values():
        assert v[0].target <= 3 * v[0].source_size + 1e-9
        assert abs(sum(r.taken for r in v) - v[0].target) <= 3 + 1
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).select("doc_id", "taken").collect())) == sorted((r.doc_id, r.taken) for r in rows)
    order = mixing.training_order(docs)
    found = [r.position for r in order.collect()]
    assert found == sorted(found) and set(docs.columns) - {"position"} <= set(order.columns)
    assert mixing.training_order(docs.limit(0)).count() == 0


def test_every_repeated_row_has_its_own_place(spark):
    """2,000 equal rows of one word meet the target to the word, and the training order holds as many copies."""
    texts = ["w"] * 2000 + [" ".join(["v"] * 100)] * 40
    docs = _docs(spark, texts, ["b"] * 2000 + ["a"] * 40).withColumn("doc_id", F.when(F.col("source") == "b", F.lit(7)).otherwise(F.col("doc_id")))
    rows = [r for r in mixing.mix(docs).collect() if r.source == "b"]
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1 and len({r.taken for r in rows}) > 1
    assert sum(len(r.positions) for r in rows) == sum(r.taken for r in rows)
    found = [(r.position, r.copy) for r in mixing.training_order(docs).where("source = 'b'").collect()]
    assert sorted(p for p, _ in found) == pytest.approx(sorted(p for r in rows for p in r.positions))


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_of_either_version(version):
    import gzip

    payloads = [b"", b"<html>\n\nhttp://x 1 2 text/html 5\n</html>", "é\r\n\r\n".encode(), bytes(range(256))]
    parts = [archives.arc_file_head(version, "f.arc"), *(archives.arc_record(version, "f.arc", i, f"http://h/{i} x", p) for i, p in enumerate(payloads))]
    found = list(archives.arc_records(b"".join(gzip.compress(p + b"\n") for p in parts)))
    assert [archives.split_http(c)[2] for _, c in found] == payloads
    assert [f["URL"] for f, _ in found] == [f"http://h/{i}%20x" for i in range(4)]
    again = list(archives.warc_records(gzip.compress(b"".join(archives.warc_record(f, c, None) + b"\n" for f, c in found))))
    assert [b for _, b in again] == [c for _, c in found] and len({h["WARC-Record-ID"] for h, _ in again}) == 4


def test_archives_round_trip(spark):
    html = ["<p>a</p>", "<p>b</p>", None, "", "<p>a</p>", "line\r\n\r\nWARC/1.1\r\n", "<p>a</p>"]
    pages = spark.createDataFrame([(i, None if i == 1 else f"http://h/{i}", h, "x") for i, h in enumerate(html)], "page_id bigint, url string, html string, record string")
    rows = {r.page_id: r for r in archives.through_archives(pages.repartition(3)).collect()}
    assert {i: r.refers_to for i, r in rows.items()} == {0: 6, 1: None, 2: 3, 3: None, 4: 6, 5: None, 6: None}
    assert [rows[i].payload_bytes for i in range(7)] == [len((h or "").encode()) for h in html]
    assert rows[3].payload_digest == archives.base32_sha1(b"") and rows[0].record_type == "revisit"
    assert archives.through_archives(pages.limit(0)).count() == 0
    assert archives.through_archives(pages, least=9).where(F.col("record_type") == "revisit").count() == 0


def test_masking_holds_a_part_of_the_batch_only():
    texts = [None, "", *(f"mail a{i}@example.org now " + "word " * 500 for i in range(1500)), None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    before, rows, parts, pool = tracemalloc.get_traced_memory()[0], 0, 0, pa.total_allocated_bytes()
    for part in pii.masked_parts(batch, 1, None):
        for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            assert i == rows and text == (texts[i] and texts[i].replace(f"a{i - 2}@example.org", "[email]"))
            rows += 1
        parts += 1
        assert pa.total_allocated_bytes() - pool < 1.2 * batch.nbytes  # one copy of a column with NULLs
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert rows == len(texts) and parts > 2 and peak < batch.nbytes, (peak, batch.nbytes)
