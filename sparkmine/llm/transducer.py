"""Token counts by a tokenizer compiled to finite-state transducers.

A BPE tokenizer with word ends is compiled into two transducers. The first cuts a text into pieces (letters, single digits, other
signs, contractions); its state after a character depends on the last characters alone, so cuts are found everywhere at once. The
second reads the bytes of a piece. Every prefix of a piece has one encoding, and its last token is the one token
that ends there and is compatible with the encoding before it (the two together are not merged otherwise). A state
holds the tokens that may still grow, with the last token and the count before each; a transition is annotated with the
change of the token count, so the count of a piece is the sum along its path. Transitions are compiled when they are
first met and kept in a bounded table. A piece begins in the start state whatever came before, so its state map is
constant; the maps of all pieces are composed by one prefix sum, and the counts of texts are differences of that scan.

The compiled alphabet is Latin-1, whose characters the normalizer changes one by one. Texts with other
characters, or with the strings of special tokens, are given to the tokenizer library; classes of characters
are read off the library too, so both ways count alike.

Scale: texts are read where they are; nothing is shuffled. The tokenizer file's content travels with the job.

Edge cases: NULL text is empty and has no tokens; rows may repeat or lack a ``doc_id``; other columns are ignored.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmine.llm.words import mix, span_hashes, text_slices

LIMIT = 2048
MOST_TRANSITIONS = 700_000  # about 150 MB with their states; beyond that the table starts anew
SPACE, LETTER, NUMBER, OTHER = range(4)
END = "</w>"
_QUOTE = 39


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Table:
    """Open-addressing map from transition to target and emitted count, looked up for many at once."""

    def __init__(self, bits: int = 16):
        self.used, self.bits = 0, bits
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, -1 where there is none."""
        out, slot, mask = np.full(len(keys), -1, np.int64), self._slots(keys), (1 << self.bits) - 1
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (there != -1)
            left, slot = left[go], (slot[go] + 1) & mask
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        while (self.used + len(keys)) * 2 > len(self.keys):
            old, there = self.values, self.keys
            some = there != -1
            self.__init__(self.bits + 1)
            self._put(there[some], old[some])
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]  # of keys that want one slot the last stays
            set_here = self.keys[slot] == keys[left]
            self.values[slot[set_here]] = values[left[set_here]]
            left, slot = left[~set_here], (slot[~set_here] + 1) & mask
        self.used += len(keys)


class Transducer:
    """Counts the tokens of pieces of bytes."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END:
            raise ValueError("not a BPE model with word ends")
        of = byte_alphabet()

        def raw(token: str) -> tuple[bytes, bool]:
            last = token.endswith(END) and token != END
            return bytes(of[c] for c in (token[: -len(END)] if last else token)), last

        self.base: dict[tuple[int, bool], int] = {}
        self.parts: dict[int, tuple[bytes, bool]] = {}
        self.child: dict[int, int] = {}  # node * 256 + byte
        self.word: dict[int, int] = {}  # node -> token that ends there
        self.last: dict[int, int] = {}  # node * 256 + byte -> token that ends a piece there
        nodes = 1
        for token, i in model["vocab"].items():
            try:
                data, last = raw(token)
            except KeyError:  # special strings that are no bytes
                continue
            if not data:
                continue
            self.parts[i] = data, last
            if len(data) == 1:
                self.base[data[0], last] = i
            node = 0
            for b in data[: len(data) - last]:
                at = node * 256 + b
                if at not in self.child:
                    self.child[at] = nodes
                    nodes += 1
                node = self.child[at]
            if last:
                self.last[node * 256 + data[-1]] = i
            else:
                self.word[node] = i
        self.open = {at // 256 for at in self.child} | {at // 256 for at in self.last}
        ids = model["vocab"]
        self.rank = {}
        for n, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[ids[a], ids[b]] = n, ids[a + b]
        self.fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.table, start = Table(), ((0, -1, 0),)
        self.states, self.numbers = [start], {start: 0}

    def encode(self, data: bytes, last: bool) -> list[int]:
        """Merge by rank, leftmost first."""
        out = [self.base[b, last and i == len(data) - 1] for i, b in enumerate(data)]
        while len(out) > 1:
            rank, at = min((self.rank.get(p, (1 << 60, 0))[0], i) for i, p in enumerate(zip(out, out[1:])))
            if rank == 1 << 60:
                break
            pair = out[at], out[at + 1]
            joined, i = [], 0
            while i < len(out):
                if i + 1 < len(out) and (out[i], out[i + 1]) == pair:
                    joined.append(self.rank[pair][1])
                    i += 2
                else:
                    joined.append(out[i])
                    i += 1
            out = joined
        return out

    def compatible(self, before: int, token: int) -> bool:
        known = self.fits.get((before, token))
        if known is None:
            data, last = self.parts[token]
            if before >= 0:
                known = self.encode(self.parts[before][0] + data, last) == [before, token]
            else:
                known = self.encode(data, last) == [token]
            self.fits[before, token] = known
        return known

    def compile(self, key: int) -> int:
        """Target and count change of a transition: state, whether the byte ends the piece, byte."""
        state, ends, b = self.states[key >> 9], key >> 8 & 1, key & 255
        if ends:
            for node, before, back in state:
                token = self.last.get(node * 256 + b)
                if token is not None and self.compatible(before, token):
                    return 1 - back + 512
            raise ValueError("a byte without token")
        grown = [(n, before, back) for node, before, back in state if (n := self.child.get(node * 256 + b)) is not None]
        for node, before, back in grown:
            token = self.word.get(node)
            if token is not None and self.compatible(before, token):
                change = 1 - back
                break
        else:
            raise ValueError("a byte without token")
        target = (*[(n, t, k + change) for n, t, k in grown if n in self.open], (0, token, 0))
        number = self.numbers.get(target)
        if number is None:
            number = self.numbers[target] = len(self.states)
            self.states.append(target)
        return number << 10 | change + 512

    def counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of every piece ``data[start:start + size]``; all pieces move one byte at a time."""
        if self.table.used > MOST_TRANSITIONS:
            self.clear()
            self.fits.clear()
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state, total = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        active = len(starts)
        for i in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes[:active], -i, "left"))  # sizes above i
            key = state[:active] << 9 | (sizes[:active] == i + 1).astype(np.int64) << 8 | data[starts[:active] + i]
            found = self.table.find(key)
            missing = np.unique(key[found < 0])
            if len(missing):
                self.table.add(missing, np.array([self.compile(int(k)) for k in missing], np.int64))
                found = self.table.find(key)
            total[:active] += (found & 1023) - 512
            state[:active] = found >> 10
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


class Pieces:
    """Cuts texts of the compiled alphabet into pieces of lower-case UTF-8 bytes."""

    def __init__(self, tokenizer):
        plain, pairs = np.zeros(256, np.uint8), np.zeros((2, 256), np.uint8)
        self.lower, self.shift = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
        for c in range(256):
            changed = tokenizer.normalizer.normalize_str(chr(c))
            kind = self._kind(tokenizer, changed)
            if c < 128:
                plain[c] = kind
                self.lower[c] = ord(changed)
            else:
                lead, cont = chr(c).encode()
                pairs[lead - 0xC2, cont] = kind
                if changed != chr(c) and kind != SPACE:
                    new_lead, new_cont = changed.encode()
                    assert new_lead == lead == 0xC3, "a change of the lead byte is not compiled"
                    self.shift[cont] = new_cont - cont
        self.plain, self.pairs = plain, pairs

    @staticmethod
    def _kind(tokenizer, c: str) -> int:
        if c == " ":
            return SPACE
        if len(tokenizer.pre_tokenizer.pre_tokenize_str("a" + c)) == 1:
            return LETTER
        return NUMBER if len(tokenizer.pre_tokenizer.pre_tokenize_str(c + c)) == 2 else OTHER

    def cut(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-case bytes, piece starts and sizes."""
        n = len(data)
        low, kind = self.lower[data], self.plain[data]
        for lead in (0xC2, 0xC3):
            at = np.flatnonzero(data == lead)
            kind[at] = kind[at + 1] = self.pairs[lead - 0xC2, data[at + 1]]
            if lead == 0xC3:
                low[at + 1] += self.shift[data[at + 1]]
        tail = (data & 0xC0) == 0x80
        begin = np.zeros(n + 1, bool)
        begin[borders] = True
        before = np.empty(n, np.uint8)
        before[0], before[1:] = SPACE, kind[:-1]
        before[begin[:n]] = SPACE
        # Contractions begin where an apostrophe does not go on a run of signs.
        quote = np.flatnonzero((low == _QUOTE) & (before != OTHER))
        text_end = borders[np.searchsorted(borders, quote, "right")] if len(quote) else quote
        one = np.where(quote + 1 < text_end, low[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < text_end, low[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        size = np.where(short, 2, np.where(long, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        held = np.zeros(n + 3, bool)
        for i in range(3):
            held[quote[size > i] + i] = True
        held = held[:n]
        after_held = np.concatenate(([False], held[:-1])) & ~begin[:n]
        start = (kind == NUMBER) | ((kind == LETTER) & ~held & ((before != LETTER) | after_held)) | ((kind == OTHER) & ~held & (before != OTHER))
        start &= ~tail
        start[quote] = True
        stop = np.append(start | (kind == SPACE), True) | begin
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
        return low, starts, stops[np.searchsorted(stops, starts, "right")] - starts


def _compiled(spec: str) -> tuple:
    """Tokenizer, pieces and transducer, kept in the Python worker between tasks."""
    kept = sys.modules.setdefault("sparkmine_worker_cache", types.ModuleType("sparkmine_worker_cache")).__dict__
    if kept.get("spec") != spec:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        kept.update(spec=spec, made=(tokenizer, Pieces(tokenizer), Transducer(spec), [t["content"].encode() for t in json.loads(spec)["added_tokens"]]))
    return kept["made"]


def count_tokens(spec: str, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Token counts of consecutive texts."""
    tokenizer, pieces, transducer, special = _compiled(spec)
    texts = len(borders) - 1
    # Texts beyond the alphabet or with special strings.
    odd = np.unique(np.searchsorted(borders, np.flatnonzero(data >= 0xC4), "right") - 1)
    raw = data.tobytes()
    if any(s in raw for s in special):
        odd = np.union1d(odd, [i for i in range(texts) if any(s in raw[borders[i] : borders[i + 1]] for s in special)]).astype(np.int64)
    if len(odd):
        kept = np.ones(texts, bool)
        kept[odd] = False
        sizes = np.diff(borders)
        data, own = data[np.repeat(kept, sizes)], np.concatenate(([0], np.cumsum(np.where(kept, sizes, 0))))
    else:
        own = borders
    out = np.zeros(texts, np.int64)
    if len(data):
        low, starts, sizes = pieces.cut(data, own)
        hashes = span_hashes(low.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, starts, starts + sizes)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        counted = transducer.counts(low, starts[first], sizes[first])[which]
        scan = np.concatenate(([0], np.cumsum(counted)))
        at = np.searchsorted(starts, own)
        out = scan[at[1:]] - scan[at[:-1]]
    for i in odd.tolist():
        out[i] = len(tokenizer.encode(raw[borders[i] : borders[i + 1]].decode(), add_special_tokens=False).ids)
    return out


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text, by the tokenizer file at ``path`` (read on the driver)."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()

    def run(batches):
        for batch in batches:
            for at, to, data, borders in text_slices(batch.column("text")):
                tokens = count_tokens(spec, data, borders)
                columns = [batch.column("doc_id").slice(at, to - at), pa.array(np.diff(borders)), pa.array(tokens), pa.array(tokens > limit)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
