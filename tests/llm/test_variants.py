"""Spelling variants against a brute-force version."""

import random
import re
import zlib

from sparkmine.llm import variants

SCHEMA = "doc_id bigint, text string, word string, n int, id int, form string, key string"


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _expected(rows):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if abs(len(x) - len(w)) < 2 and _near(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, form, None, len(near), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][1]:
            root = out[root][1]
        out[w][2] = root
    return {w: tuple(v) for w, v in out.items()}


def _got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows], SCHEMA)
    found = variants.variants(df).collect()
    out = {r["word"]: (r["n"], r["form"], r["root"], r["n_near"], r["form_n"]) for r in found}
    assert len(out) == len(found)
    return out


def test_random_words(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(250)]
    rows = [(i, " ".join(rng.choice(words[: rng.randint(1, 250)]) for _ in range(rng.randint(0, 120)))) for i in range(200)]
    rows += [(None, "AAAAA aaaaa Aaaaa ÀÀÀÀÀ àbbbb-bbbbb"), (5, None), (6, ""), (7, "123 $$$$$"), *[(9, "chains chainz")] * 4]
    expected = _expected(rows)
    assert sum(v[1] is not None for v in expected.values()) > 20 and any(v[2] != (v[1] or w) for w, v in expected.items())
    assert _got(spark, rows) == expected


def test_long_words(spark):
    """Around the length from which rotations are filed by fingerprint, and far beyond."""
    rng = random.Random(6)
    rows = []
    for size in (61, 62, 63, 64, 65, 66, 400, 5000):
        word = "".join(rng.choice("abcdefgh") for _ in range(size))
        other = [word[:-1], word + "q", word[:30] + "q" + word[31:], word[:7] + "q" + word[7:], word[1:]]
        rows += [(size, " ".join([word] * 20 + other * 3))]
    expected = _expected(rows)
    assert sum(v[3] > 0 for v in expected.values()) >= 40
    assert _got(spark, rows) == expected


def test_one_hot_form(spark):
    """A word that many others point at, and a document that holds most rows."""
    word = "variable"
    others = {word[:i] + c + word[i + 1 :] for i in range(8) for c in "bcdfghjk"} | {word[:i] + c + word[i:] for i in range(9) for c in "bcdfghjk"}
    rows = [(1, " ".join([word] * 50 + sorted(others - {word}) * 3))]
    expected = _expected(rows)
    assert max(v[3] for v in expected.values()) > 100
    assert _got(spark, rows) == expected


def test_no_words(spark):
    assert _got(spark, []) == {}
    assert _got(spark, [(1, None), (2, "abc abc abc"), (3, "longword")]) == {}
