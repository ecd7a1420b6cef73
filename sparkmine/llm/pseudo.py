"""Language-model scores: masked pseudo-likelihood.

Every word is predicted from the two words before and the two words after it, itself masked: embeddings of the four are joined,
go through a tanh layer and give a softmax over word classes; within its class a word has its share of the corpus
counts. The log-probabilities of all words of a document, summed, are its score.

Words are hashed into ``BUCKETS`` buckets, so that counts, classes and model have a fixed size. Counts are taken over all
documents. Classes have about equal mass, so frequent words are classes of their own. The network is trained in numpy on all
word places of every document, dealt into ``SHARE`` parts by hash that are learnt in turn: each task runs Adam over its own
places from common weights, and the weights are averaged over all places, ``ROUNDS`` times.

Scale: one pass for the counts, one per round and one for the scores; texts are never shuffled. Counts and weights are
summed by Spark, so the driver gets one value per bucket or weight at most, whatever the number of tasks.

Edge cases: NULL or blank text has no words, score 0 and no mean; one word alone is predicted from padding. Rows may
repeat or lack a ``doc_id``; other columns are ignored. Without any words every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.words import Words, mix, split_words, text_slices

BUCKET_BITS = 18
CLASSES = 64
OWN_ROWS = 4032  # most frequent buckets with an embedding of their own
EMBED, HIDDEN, SIDE = 16, 32, 2
SHARE, ROUNDS, BATCH, RATE = 32, 2, 1024, 0.01
PIECE, SAFE = 256, 60  # places of one matrix product, few enough for the fast kernels of BLAS; class scores exp takes unshifted
SMOOTH = 0.1
CACHED_BYTES, DEALT = 1 << 18, 1 << 18  # bytes of text split at once, words dealt into parts at once
_PAD = OWN_ROWS + CLASSES


@dataclass
class Vocabulary:
    """Class, embedding row and log share in the class of every bucket."""

    klass: np.ndarray
    row: np.ndarray
    share: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> "Vocabulary":
        order = np.argsort(-counts, kind="stable")
        mass = np.cumsum(counts[order], dtype=np.float64)
        klass = np.empty(len(counts), np.int32)
        klass[order] = np.minimum((mass - counts[order]) * CLASSES // max(mass[-1], 1), CLASSES - 1)
        row = OWN_ROWS + klass
        row[order[:OWN_ROWS]] = np.arange(min(OWN_ROWS, len(order)))
        smoothed = counts + SMOOTH
        total = np.bincount(klass, weights=smoothed, minlength=CLASSES)
        return Vocabulary(klass, row.astype(np.int32), (np.log(smoothed) - np.log(total[klass])).astype(np.float32))


def buckets(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def contexts(words: Words, row: np.ndarray) -> np.ndarray:
    """Embedding rows of the neighbours of every word; padding beyond its text."""
    n = len(row)
    out = np.full((n, 2 * SIDE), _PAD, np.int32)
    for column, step in enumerate([s for s in range(-SIDE, SIDE + 1) if s]):
        a, b = max(0, -step), n - max(0, step)
        if b > a:
            same = words.doc[a:b] == words.doc[a + step : b + step]
            out[a:b, column] = np.where(same, row[a + step : b + step], _PAD)
    return out


def fresh_weights(seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"embed": (_PAD + 1, EMBED), "in": (2 * SIDE * EMBED, HIDDEN), "in_b": (HIDDEN,), "out": (HIDDEN, CLASSES), "out_b": (CLASSES,)}
    return {k: (rng.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}


def class_scores(weights: dict, hidden: np.ndarray) -> np.ndarray:
    """Class scores, a column a place like ``hidden``, the largest of a place at 0."""
    scores = weights["out"].T @ hidden
    scores += weights["out_b"][:, None]
    scores -= scores.max(axis=0)
    return scores


def layers(weights: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, a row a place; hidden layer and class scores, a column a place."""
    inputs = weights["embed"].take(context.ravel(), axis=0).reshape(len(context), -1)
    hidden = weights["in"].T @ inputs.T
    hidden += weights["in_b"][:, None]
    np.tanh(hidden, out=hidden)
    return inputs, hidden, class_scores(weights, hidden)


def log_class(weights: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden layer and class log-probabilities, a row a place."""
    inputs, hidden, scores = layers(weights, context)
    return inputs, hidden.T, (scores - np.log(np.exp(scores).sum(axis=0))).T


def safe(out: np.ndarray) -> bool:
    """Whether class scores, with a hidden layer in -1 to 1, are so near 0 that exp needs no shift.

    At 60 the sums of exp over a batch and their inverses stay normal 32-bit numbers.
    """
    return np.abs(out).sum(axis=0).max() <= SAFE


def places_of_classes(klass: np.ndarray, piece: int) -> np.ndarray:
    """Where the score of each place's class stands in ``(pieces, CLASSES, piece)`` scores."""
    i = np.arange(len(klass))
    return (i // piece * CLASSES + klass) * piece + i % piece


class Adam:
    """Weights and their two moments, all 32 bits wide; of the embeddings only the rows of a batch move.

    The first moment is held 10 times, the second 100 times as large. A step works in arrays that are kept from one to
    the next: ``(pieces, values, places)``, a column a place where not said otherwise.
    """

    def __init__(self, weights: dict):
        dense = [k for k in sorted(weights) if k != "embed"]
        ends = np.cumsum([weights[k].size for k in dense])
        self.dense = np.zeros((3, ends[-1]), np.float32)
        self.d_dense = np.zeros(ends[-1], np.float32)
        self.embed = np.zeros((4, *weights["embed"].shape), np.float32)  # the last holds gradients, all 0 between steps
        self.weights, self.grad = {"embed": self.embed[0]}, {}
        for k, end in zip(dense, ends):
            self.weights[k], self.grad[k] = (x[end - weights[k].size : end].reshape(weights[k].shape) for x in (self.dense[0], self.d_dense))
        for k, v in weights.items():
            self.weights[k][...] = v
        # "out_b" follows "out", so both are one matrix for a hidden layer that ends in a row of ones.
        self.out, self.d_out = (x[-(HIDDEN + 1) * CLASSES :].reshape(-1, CLASSES) for x in (self.dense[0], self.d_dense))
        self.rooms: dict[str, np.ndarray] = {}
        self.step = 0

    def room(self, name: str, *shape: int, dtype: type = np.float32) -> np.ndarray:
        """A kept array of this shape; it holds what the last user of the name left."""
        size = math.prod(shape)
        if name not in self.rooms or len(self.rooms[name]) < size:
            self.rooms[name] = np.empty(size, dtype)
        return self.rooms[name][:size].reshape(shape)

    def learn(self, context: np.ndarray, klass: np.ndarray) -> None:
        w, n, room = self.weights, len(context), self.room
        piece = n if n % PIECE else PIECE
        at = room("at", context.size, dtype=np.int64)
        at[...] = context.ravel()
        # Told to clip, take writes to its output directly; no row is out of range.
        inputs = w["embed"].take(at, axis=0, out=room("inputs", len(at), EMBED), mode="clip").reshape(-1, piece, context.shape[1] * EMBED)
        inputs_t = inputs.transpose(0, 2, 1)
        whole = room("hidden", len(inputs), HIDDEN + 1, piece)
        hidden, whole[:, -1] = whole[:, :-1], 1
        np.matmul(w["in"].T, inputs_t, out=hidden)
        hidden += w["in_b"][:, None]
        np.tanh(hidden, out=hidden)
        # Gradients of the scores are left undivided by the sums of exp; the hidden layer, half their size, is divided instead.
        d_scores = np.matmul(self.out.T, whole, out=room("scores", len(inputs), CLASSES, piece))
        if not safe(self.out):
            d_scores -= d_scores.max(axis=1, keepdims=True)
        np.exp(d_scores, out=d_scores)
        total = d_scores.sum(axis=1, keepdims=True)
        np.subtract.at(d_scores.reshape(-1), places_of_classes(klass, piece), total.reshape(-1))
        share = 1 / (n * total)
        d_hidden = np.matmul(w["out"], d_scores, out=room("d_hidden", *hidden.shape))
        d_hidden *= share
        slope = np.multiply(hidden, hidden, out=room("slope", *hidden.shape))
        np.subtract(1, slope, out=slope)
        d_hidden *= slope
        whole *= share
        self.d_out[...] = np.matmul(d_scores, whole.transpose(0, 2, 1)).sum(axis=0).T
        d_hidden_t = d_hidden.transpose(0, 2, 1)
        self.grad["in"][...] = np.matmul(inputs_t, d_hidden_t).sum(axis=0)
        self.grad["in_b"][...] = d_hidden.sum(axis=(0, 2))
        d_inputs = np.matmul(d_hidden_t, w["in"].T, out=inputs)
        self.step += 1
        self._move(self.dense, self.d_dense, room("move", *self.d_dense.shape))
        # Rows of embeddings are summed two values at a time, as complex numbers, and put back as items of their size.
        for d_pair, pair in zip(self.embed[3].view(np.complex64).T, d_inputs.view(np.complex64).reshape(len(at), -1).T):
            np.add.at(d_pair, at, pair)
        some = room("some", self.embed.shape[1], dtype=bool)
        some[...] = False
        some[at] = True
        rows = np.flatnonzero(some)
        moved = self.embed.take(rows, axis=1, out=room("scores", 4, len(rows), EMBED), mode="clip")
        self._move(moved[:3], moved[3], room("hidden", len(rows), EMBED))
        moved[3] = 0
        item = np.dtype((np.void, self.embed.strides[1]))
        for kept, part in zip(self.embed.view(item)[..., 0], moved.view(item)[..., 0]):
            kept[rows] = part

    def _move(self, state: np.ndarray, g: np.ndarray, move: np.ndarray) -> None:
        value, first, second = state
        np.multiply(g, g, out=move)
        second *= 0.99
        second += move
        first *= 0.9
        first += g
        np.sqrt(second, out=move)
        move += 1e-7
        np.divide(first, move, out=move)
        move *= RATE * math.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        value -= move


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """How often the words of each bucket occur in all documents."""

    def run(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, _, words in word_slices(batch.column("text")):
                np.add.at(counts, buckets(words), 1)
        some = np.flatnonzero(counts)
        for a in range(0, len(some), 65536):
            part = some[a : a + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part])], ["bucket", "n"])

    summed = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[summed["bucket"].to_numpy(dtype=np.int64)] = summed["n"].to_numpy(dtype=np.int64)
    return counts


def flat(weights: dict) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, v in sorted(fresh_weights().items()):
        out[k] = values[at : at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out


def place_parts(words: Words, seed: int) -> np.ndarray:
    """Which of SHARE parts each word place belongs to, by the hash of the word with its place in the text."""
    place = (np.arange(len(words.hashes)) - words.first[words.doc]).astype(np.uint64)
    return (mix(words.hashes ^ mix(place + np.uint64(seed * 1_000_003))) % np.uint64(SHARE)).astype(np.uint8)


def chosen_places(words: Words, seed: int, part: int = 0) -> np.ndarray:
    """The word places of one part."""
    return np.flatnonzero(place_parts(words, seed) == part)


def word_slices(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """``(from row, to row, words)`` of consecutive texts, few enough for a core's cache."""
    for at, to, data, borders in text_slices(column, CACHED_BYTES):
        yield at, to, split_words(data, borders, lower=True)


def dealt_places(batches, vocabulary: Vocabulary, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Contexts and classes of all places, of ``DEALT`` words or a little more at a time and part after part."""
    held, size = [], 0
    for batch in batches:
        for _, _, words in word_slices(batch.column("text")):
            own = buckets(words)
            held.append((place_parts(words, seed), contexts(words, vocabulary.row[own]), vocabulary.klass[own]))
            size += len(own)
            if size >= DEALT:
                yield from _deal(held)
                held, size = [], 0
    if held:
        yield from _deal(held)


def _deal(held: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    parts, context, klass = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(parts, kind="stable")  # every place once, those of a text apart from each other
    context, klass = context.take(order, axis=0), klass[order]
    borders = np.searchsorted(parts[order], np.arange(SHARE + 1))
    for a, b in zip(borders, borders[1:]):
        yield context[a:b], klass[a:b]


def training_round(docs: DataFrame, vocabulary: Vocabulary, weights: dict, seed: int) -> dict:
    """Train in every task on all its places, from the same weights, and average by the number of places."""

    def run(batches):
        model, seen, kept = Adam(weights), 0, []
        for context, klass in dealt_places(batches, vocabulary, seed):
            kept.append((context, klass))
            if sum(len(k) for _, k in kept) >= 16 * BATCH:
                seen += _learn(model, kept, seed)
                kept = []
        seen += _learn(model, kept, seed)
        if seen:
            values = flat(model.weights).astype(np.float64) * seen
            for a in range(0, len(values), 65536):
                part = values[a : a + 65536]
                columns = [pa.array(np.arange(a, a + len(part), dtype=np.int32)), pa.array(part), pa.array(np.full(len(part), seen))]
                yield pa.RecordBatch.from_arrays(columns, ["i", "weighted", "n"])

    rows = docs.select("text").mapInArrow(run, "i int, weighted double, n bigint")
    mean = rows.groupBy("i").agg((F.sum("weighted") / F.sum("n")).alias("value")).toPandas()
    if mean.empty:
        return weights
    values = np.zeros(len(mean))
    values[mean["i"].to_numpy(dtype=np.int64)] = mean["value"].to_numpy()
    return shaped(values)


def _learn(model: Adam, kept: list, seed: int) -> int:
    if not kept:
        return 0
    context, klass = (np.concatenate(x) for x in zip(*kept))
    order = np.random.default_rng(seed + len(klass)).permutation(len(klass))
    for a in range(0, len(order), BATCH):
        part = order[a : a + BATCH]
        model.learn(context.take(part, axis=0), klass[part])
    return len(klass)


def trained(docs: DataFrame, seed: int = 0, rounds: int = ROUNDS) -> tuple[Vocabulary, dict]:
    vocabulary = Vocabulary.of(corpus_counts(docs))
    weights = fresh_weights(seed)
    for i in range(rounds):
        weights = training_round(docs, vocabulary, weights, seed + i)
    return vocabulary, weights


def word_log_probs(words: Words, vocabulary: Vocabulary, weights: dict) -> np.ndarray:
    """Log-probability of every word given its neighbours."""
    own = buckets(words)
    n, short = len(own), -len(own) % PIECE
    context = np.pad(contexts(words, vocabulary.row[own]), ((0, short), (0, 0)))
    klass, at, total = np.pad(vocabulary.klass[own], (0, short)), np.empty(n + short, np.float32), np.empty(n + short, np.float32)
    # The weights stand still here, so each embedding row's part in the hidden layer is formed once for each column of the context.
    parts = [weights["embed"] @ m for m in np.split(weights["in"], context.shape[1])]
    parts[0] += weights["in_b"]
    plain = safe(np.vstack([weights["out"], weights["out_b"]]))
    mass = np.exp(weights["out_b"]) if plain else None
    for a in range(0, n, 4 * PIECE):
        b = min(a + 4 * PIECE, n + short)
        some = context[a:b].T
        hidden = parts[0].take(some[0], axis=0)
        for part, rows in zip(parts[1:], some[1:]):
            hidden += part.take(rows, axis=0)
        np.tanh(hidden, out=hidden)
        scores = weights["out"].T @ hidden.reshape(-1, PIECE, HIDDEN).transpose(0, 2, 1)
        if not plain:
            scores += weights["out_b"][:, None]
            scores -= scores.max(axis=1, keepdims=True)
        at[a:b] = scores.reshape(-1).take(places_of_classes(klass[a:b], PIECE))
        np.exp(scores, out=scores)
        total[a:b] = (mass @ scores if plain else scores.sum(axis=1)).reshape(-1)
    out = at[:n] - np.log(total[:n]) + vocabulary.share[own]
    return out + weights["out_b"][klass[:n]] if plain else out


def pseudo_likelihood(docs: DataFrame, model: tuple[Vocabulary, dict] | None = None) -> DataFrame:
    """``doc_id, n_words, log_prob, mean_log_prob`` of every document."""
    vocabulary, weights = model or trained(docs)

    def run(batches):
        for batch in batches:
            for at, to, words in word_slices(batch.column("text")):
                scan = np.concatenate(([0.0], np.cumsum(word_log_probs(words, vocabulary, weights), dtype=np.float64)))
                total, n = scan[words.first[1:]] - scan[words.first[:-1]], words.counts()
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, to - at), pa.array(n), pa.array(total), mean], ["doc_id", "n_words", "log_prob", "mean_log_prob"])

    schema = "doc_id bigint, n_words bigint, log_prob double, mean_log_prob double"
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
