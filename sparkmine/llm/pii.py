"""Personal data: base rules and a character-level bidirectional LSTM with CRF transitions.

The base rules find emails, addresses, card and phone numbers. They also label the training spans: from a bounded sample of
texts (``TRAIN_TEXTS``), windows of characters are cut, some with their phone prefix or separators changed, and a
small BiLSTM-CRF is trained on them in numpy. Overlapping windows of every text are decoded (Viterbi); spans that touch an
inner window edge are left to the neighbour window that holds them whole. The spans of all windows of a text are reconciled
at once: the set of non-overlapping spans with the largest total score is taken (weighted intervals), base spans first.

A span of these kinds holds a digit or an ``@``, so windows without either are not decoded; every other one is.

Scale: texts are read where they are, nothing is shuffled; the model (some thousand weights) is sent to the tasks.

Edge cases: NULL text is empty; no texts or no labelled spans leave the model out and the base spans stand; rows may
repeat; other columns pass through ``redact`` unchanged.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.words import text_slices

KINDS = ("email", "ip", "card", "phone")
TRAIN_TEXTS = 600
TRAIN_CHARS = 1500  # of the surroundings of digits and @ in a sampled text
TRAIN_WINDOWS = 900
WIDTH, STRIDE = 96, 48
HIDDEN, EMBED = 20, 12
EPOCHS, RATE, BATCH = 8, 0.02, 30
LEAST_SCORE = 0.6
N_TAGS = 1 + 2 * len(KINDS)
# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match of digits can only begin where a run of digits begins, so no other start needs to be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans by kind, leftmost and non-overlapping; matches that fail their check are dropped."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            found["card"].append(m.span())
    if "+" in text:
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


# Character classes: letters of either case share their own code, other scripts share one.
_SYMBOLS = "0123456789@.+-()_%/:=#*\n \"',"
_CODES = np.full(256, 1, np.int64)
_CODES[[ord(c) for c in _SYMBOLS]] = np.arange(2, 2 + len(_SYMBOLS))
for _i in range(26):
    _CODES[97 + _i] = _CODES[65 + _i] = 2 + len(_SYMBOLS) + _i
N_CODES = 2 + len(_SYMBOLS) + 26


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _CODES[np.minimum(points, 255)] * (points < 256) + (points >= 256)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Embedding, two LSTMs (one per direction), tag scores and CRF transitions."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int) -> "Tagger":
        rng = np.random.default_rng(seed)

        def draw(*shape, scale=0.2):
            return rng.normal(0, scale, shape).astype(np.float32)

        bias = np.zeros((2, 1, 4 * HIDDEN), np.float32)
        bias[:, :, HIDDEN : 2 * HIDDEN] = 1  # remember at first
        w = {"embed": draw(N_CODES, EMBED), "x": draw(2, EMBED, 4 * HIDDEN), "h": draw(2, HIDDEN, 4 * HIDDEN), "b": bias}
        w |= {"out": draw(2 * HIDDEN, N_TAGS), "out_b": np.zeros(N_TAGS, np.float32), "move": np.zeros((N_TAGS, N_TAGS), np.float32)}
        return Tagger(w)

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, dict]:
        """Tag scores (windows x places x tags) and what the backward pass needs."""
        w = self.weights
        n, t = codes.shape
        both = np.stack([codes, codes[:, ::-1]])
        inputs = w["embed"][both]
        driven = inputs @ w["x"][:, None] + w["b"][:, :, None]
        h = c = np.zeros((2, n, HIDDEN), np.float32)
        gates, cells, states = [], [c], [h]
        for i in range(t):
            z = driven[:, :, i] + h @ w["h"]
            s = _sigmoid(z[..., : 3 * HIDDEN])
            g = np.tanh(z[..., 3 * HIDDEN :])
            c = s[..., HIDDEN : 2 * HIDDEN] * c + s[..., :HIDDEN] * g
            h = s[..., 2 * HIDDEN :] * np.tanh(c)
            gates.append((s, g))
            cells.append(c)
            states.append(h)
        hs = np.stack(states[1:], axis=2)
        joined = np.concatenate([hs[0], hs[1][:, ::-1]], axis=-1)
        return joined @ w["out"] + w["out_b"], {"both": both, "inputs": inputs, "gates": gates, "cells": cells, "states": states, "joined": joined}

    def crf(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log normalizer, tag marginals and expected moves of every window."""
        move = self.weights["move"]
        n, t, k = scores.shape
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for i in range(1, t):
            ahead[:, i] = scores[:, i] + _logsum(ahead[:, i - 1, :, None] + move, 1)
        for i in range(t - 2, -1, -1):
            back[:, i] = _logsum(move + (scores[:, i + 1] + back[:, i + 1])[:, None], 2)
        total = _logsum(ahead[:, -1], 1)
        marginal = np.exp(ahead + back - total[:, None, None])
        pairs = np.exp(ahead[:, :-1, :, None] + move + (scores + back)[:, 1:, None] - total[:, None, None, None])
        return total, marginal, pairs.sum(axis=(0, 1))

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        scores, kept = self.forward(codes)
        _, marginal, moves = self.crf(scores)
        n, t, k = scores.shape
        d_scores = marginal
        d_scores[np.arange(n)[:, None], np.arange(t), tags] -= 1
        np.add.at(moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        d_scores = (d_scores / n).astype(np.float32)
        flat = d_scores.reshape(-1, k)
        grad = {"move": (moves / n).astype(np.float32), "out": kept["joined"].reshape(-1, 2 * HIDDEN).T @ flat, "out_b": flat.sum(0)}
        d_joined = d_scores @ w["out"].T
        d_hs = np.stack([d_joined[..., :HIDDEN], d_joined[:, ::-1, HIDDEN:]])
        d_z = np.empty((2, n, t, 4 * HIDDEN), np.float32)
        d_h = d_c = np.zeros((2, n, HIDDEN), np.float32)
        turn = w["h"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            (s, g), c, before = kept["gates"][i], kept["cells"][i + 1], kept["cells"][i]
            d_h = d_h + d_hs[:, :, i]
            s_in, s_keep, s_out = s[..., :HIDDEN], s[..., HIDDEN : 2 * HIDDEN], s[..., 2 * HIDDEN :]
            soft = np.tanh(c)
            d_c = d_c + d_h * s_out * (1 - soft * soft)
            d_s = np.concatenate([d_c * g, d_c * before, d_h * soft], axis=-1) * s * (1 - s)
            d_z[:, :, i] = np.concatenate([d_s, d_c * s_in * (1 - g * g)], axis=-1)
            d_c = d_c * s_keep
            d_h = d_z[:, :, i] @ turn
        states = np.stack(kept["states"][:-1], axis=2).reshape(2, -1, HIDDEN)
        flat_z = d_z.reshape(2, -1, 4 * HIDDEN)
        grad["h"] = states.transpose(0, 2, 1) @ flat_z
        grad["x"] = kept["inputs"].reshape(2, -1, EMBED).transpose(0, 2, 1) @ flat_z
        grad["b"] = flat_z.sum(1)[:, None]
        d_in = (flat_z @ w["x"].transpose(0, 2, 1)).reshape(-1, EMBED)
        grad["embed"] = np.zeros_like(w["embed"])
        np.add.at(grad["embed"], kept["both"].ravel(), d_in)
        return grad

    def train(self, codes: np.ndarray, tags: np.ndarray, seed: int = 0, epochs: int = EPOCHS) -> "Tagger":
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for a in range(0, len(order), BATCH):
                step += 1
                part = order[a : a + BATCH]
                for k, g in self.gradients(codes[part], tags[part]).items():
                    g = np.clip(g, -5, 5)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.weights[k] = self.weights[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        return self

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of every window and the probability of each."""
        scores, _ = self.forward(codes)
        n, t, k = scores.shape
        move, best = self.weights["move"], scores[:, 0]
        came = np.empty((n, t, k), np.int8)
        for i in range(1, t):
            step = best[:, :, None] + move
            came[:, i] = step.argmax(1)
            best = step.max(1) + scores[:, i]
        tags = np.empty((n, t), np.int64)
        tags[:, -1] = best.argmax(1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = came[np.arange(n), i, tags[:, i]]
        sure, some = np.ones((n, t)), np.flatnonzero(tags.any(axis=1))
        if len(some):
            sure[some] = np.take_along_axis(self.crf(scores[some])[1], tags[some][..., None], 2)[..., 0]
        return tags, sure


def window_starts(text: str, codes: np.ndarray | None = None) -> np.ndarray:
    """Starts of the overlapping windows that hold a digit or an ``@``."""
    codes = encode(text) if codes is None else codes
    last = max(0, -(-(len(codes) - WIDTH) // STRIDE))
    hot = np.flatnonzero((codes >= 2) & (codes <= 12))  # ten digits and @
    slots = np.unique(np.concatenate([hot // STRIDE, hot // STRIDE - 1]))
    return slots[(slots >= 0) & (slots <= last)] * STRIDE


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WIDTH, np.int64)
    part = codes[start : start + WIDTH]
    out[: len(part)] = part
    return out


def _tags(text: str) -> np.ndarray:
    tags = np.zeros(len(text), np.int64)
    for k, kind in enumerate(KINDS):
        for a, b in base_spans(text)[kind]:
            tags[a:b] = 2 + 2 * k
            tags[a] = 1 + 2 * k
    return tags


def varied(text: str, rng: np.random.Generator) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The text, and if it has a phone or card number, a copy with these written in another way; both with spans."""
    spans = sorted((a, b, k) for k, found in base_spans(text).items() for a, b in found)
    out, pieces, moved, at = [(text, spans)], [], [], 0
    if not any(k in ("phone", "card") for _, _, k in spans):
        return out
    for a, b, kind in spans:
        if a < at:
            continue
        pieces.append(text[at:a])
        span = text[a:b]
        if kind == "phone":
            number = re.sub(r"^\+[0-9]{1,3}[ .-]?", rng.choice(["", "0", "00 "]), span)
            span = number if rng.random() < 0.5 else number.replace(" ", rng.choice([".", "-"]))
        elif kind == "card" and span.isdigit():
            span = rng.choice([" ", "-"]).join(span[i : i + 4] for i in range(0, len(span), 4))
        start = sum(map(len, pieces))
        pieces.append(span)
        moved.append((start, start + len(span), kind))
        at = b
    out.append(("".join([*pieces, text[at:]]), moved))
    return out


def training_windows(texts: list[str], limit: int = TRAIN_WINDOWS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows of characters and tags; half of the room goes to windows with spans."""
    rng = np.random.default_rng(seed)
    with_span, without = [], []
    for text in texts:
        for version, spans in varied(text, rng):
            codes, tags = encode(version), np.zeros(len(version), np.int64)
            for a, b, kind in spans:
                tags[a:b] = 2 + 2 * KINDS.index(kind)
                tags[a] -= 1
            for start in window_starts(version, codes):
                own = np.zeros(WIDTH, np.int64)
                own[: len(tags[start : start + WIDTH])] = tags[start : start + WIDTH]
                (with_span if own.any() else without).append((_window(codes, start), own))
    rng.shuffle(with_span)
    rng.shuffle(without)
    rows = with_span[: limit * 2 // 3] + without[: limit // 3]
    if not with_span:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64)
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows])


def train_tagger(docs: DataFrame, texts: int = TRAIN_TEXTS, seed: int = 0) -> Tagger | None:
    """A tagger from a bounded sample: the ``texts`` texts with a digit or @ whose hashes are smallest, cut around these."""
    around = F.concat_ws(" ", F.regexp_extract_all("text", F.lit(r"[^@0-9]{0,60}[@0-9][^\n]{0,60}"), F.lit(0)))
    sample = docs.where(F.col("text").rlike("[@0-9]")).select(F.xxhash64("text", F.lit(seed)).alias("h"), F.substring(around, 1, TRAIN_CHARS).alias("text"))
    rows = sample.distinct().orderBy("h").limit(texts).collect()
    codes, tags = training_windows([r["text"] for r in rows], seed=seed)
    return Tagger.fresh(seed).train(codes, tags, seed) if len(codes) else None


def _proposals(tags: np.ndarray, sure: np.ndarray, start: int, size: int) -> Iterator[tuple[int, int, str, float]]:
    """Spans of one decoded window that do not touch an inner edge."""
    room = min(WIDTH, size - start)
    i = 0
    while i < room:
        if tags[i] == 0 or tags[i] % 2 == 0:
            i += 1
            continue
        j = i + 1
        while j < room and tags[j] == tags[i] + 1:
            j += 1
        if (i > 0 or start == 0) and (j < WIDTH or start + j == size):
            yield start + i, start + j, KINDS[(tags[i] - 1) // 2], float(sure[i:j].min())
        i = j


def reconcile(found: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str]]:
    """Non-overlapping spans with the largest total of score times length."""
    found = sorted(set(found), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in found]
    best: list[tuple[float, int, bool]] = [(0.0, 0, False)]
    for i, (a, b, _, score) in enumerate(found):
        before = bisect_right(ends, a, 0, i)
        with_it = best[before][0] + score * (b - a)
        best.append((with_it, before, True) if with_it > best[-1][0] else (best[-1][0], i, False))
    out, i = [], len(found)
    while i:
        _, before, taken = best[i]
        if taken:
            out.append(found[i - 1][:3])
        i = before
    return out[::-1]


def _plausible(text: str, kind: str) -> bool:
    """Kind-specific floor for what the model adds."""
    digits = len(_digits(text))
    if kind == "email":
        return "@" in text and "." in text.split("@")[-1].strip(".")
    low, high = {"ip": (4, 12), "card": (13, 19), "phone": (9, 15)}[kind]
    return low <= digits <= high


def find_spans(texts: list[str], tagger: Tagger | None, least: float = LEAST_SCORE) -> list[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
    """For each text its base spans and all spans, by kind."""
    bases = [base_spans(t) for t in texts]
    asked, codes_of = [], {}
    if tagger is not None:
        for i, text in enumerate(texts):
            if re.search("[@0-9]", text):
                codes_of[i] = encode(text)
                asked += [(i, int(s)) for s in window_starts(text, codes_of[i])]
    proposals: dict[int, list] = {}
    for a in range(0, len(asked), 256):
        part = asked[a : a + 256]
        tags, sure = tagger.decode(np.array([_window(codes_of[i], s) for i, s in part]))
        for (i, start), own_tags, own_sure in zip(part, tags, sure):
            if own_tags.any():
                proposals.setdefault(i, []).extend(_proposals(own_tags, own_sure, start, len(texts[i])))
    out = []
    for i, (text, base) in enumerate(zip(texts, bases)):
        every = {k: list(v) for k, v in base.items()}
        taken = sorted(s for spans in base.values() for s in spans)
        starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max, initial=0))
        free = [p for p in proposals.get(i, ()) if p[3] >= least and reach[bisect_left(starts, p[1])] <= p[0] and _plausible(text[p[0] : p[1]], p[2])]
        for a, b, kind in reconcile(free):
            every[kind].append((a, b))
        out.append((base, {k: sorted(v) for k, v in every.items()}))
    return out


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def _parts(column: pa.Array) -> Iterator[list[str]]:
    """Bounded parts of a text column; NULL is empty."""
    at = 0
    for _, to, _, _ in text_slices(column):
        yield [t or "" for t in column.slice(at, to - at).to_pylist()]
        at = to


def personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``doc_id``, the count of base spans by kind, ``base`` and ``spans`` as text, one row per input row."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"]

    def run(batches):
        for batch in batches:
            rows = [r for part in _parts(batch.column("text")) for r in find_spans(part, tagger)]
            counts = [pa.array([len(b[k]) for b, _ in rows], pa.int64()) for k in KINDS]
            texts = [pa.array([joined(r[i]) for r in rows], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, *texts], names)

    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, spans string"
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def masked(text: str, spans: dict[str, list[Span]]) -> str:
    """Each span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, found in spans.items() for a, b in found):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked_parts(batch: pa.RecordBatch, place: int, tagger: Tagger | None) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with the spans of the texts in column ``place`` masked; a whole batch is never built anew."""
    at = 0
    for part in _parts(batch.column(place)):
        rows = batch.slice(at, len(part))
        at += len(part)
        valid = rows.column(place).is_valid().to_pylist()
        new = [masked(t, s) if ok else None for t, (_, s), ok in zip(part, find_spans(part, tagger), valid)]
        columns = [pa.array(new, c.type) if i == place else c for i, c in enumerate(rows.columns)]
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def redact(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """The documents with every span masked; other columns are unchanged, a NULL text stays NULL."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield from masked_parts(batch, place, tagger)

    return docs.mapInArrow(run, docs.schema)
