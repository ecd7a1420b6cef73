"""Chat formatting: exact round trips against digests taken straight from the turns."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from sparkmine.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, slice int, part int, token_ids int"


@pytest.fixture(scope="module")
def codec():
    return chat.Codec.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _formatted(role, text):
    def plain(x):
        for mark in chat.MARKS:
            for k in range(5, -1, -1):
                x = x.replace(mark[0] + "\\" * k + mark[1:], f"\0{chat.MARKS.index(mark)}:{k}\0")
        for i, mark in enumerate(chat.MARKS):
            for k in range(6):
                x = x.replace(f"\0{i}:{k}\0", mark[0] + "\\" * (k + 1) + mark[1:])
        return x

    if role == "user":
        return f"<s>[INST]{plain(text)}[/INST]"
    return f"{plain(text)}</s>" if role == "assistant" else f"<<SYS>>{plain(role)}<</SYS>>{plain(text)}</s>"


def _expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        whole = "".join(_formatted(r, t) for *_, r, t in turns)
        out[conv] = (len(turns), _sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(learned), _sha(learned), len(whole))
    return out


def _got(spark, codec, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    found = chat.read_back(chat.assemble(df, codec), codec).collect()
    out = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) for r in found}
    assert len(out) == len(found)
    return out


def _texts(rng):
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "\\", "<\\", "s>", "[", "/INST]", "ok", " ", "\n", "é", "漢字", "👍🏽", "<\\\\s>", "\0"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))


def test_random_conversations(spark, codec):
    rng = random.Random(8)
    roles = ["user", "assistant", "assistant", "system", None, "", "<s>", "tool\nx"]
    rows = [(conv, rng.choice([None, 0, 1, 2, 3]), rng.choice(roles), rng.choice([None, _texts(rng), _texts(rng)])) for conv in [None, *range(60)] for _ in range(rng.randint(1, 9))]
    rows += [rows[0]] * 3
    assert _got(spark, codec, rows) == _expected(rows)


def test_hot_conversation_and_long_texts(spark, codec, monkeypatch):
    rng = random.Random(9)
    rows = [(5, i, ("user", "assistant")[i % 2], f"{i} " + _texts(rng) * 3) for i in range(3000)]
    rows += [(i, 0, "assistant", "same") for i in range(6, 40)] + [(4, 0, "user", "a b" * 60_000), (4, 1, "assistant", " " * 90_000 + "x" + "\n" * 70_000)]
    rows += [(3, 1, "user", "equal turns")] * 500
    assert _got(spark, codec, rows) == _expected(rows)
    # Parts and chunks of a few turns give the same conversations.
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    parts = chat.assemble(df, codec).collect()
    assert max(r["part"] for r in parts) > 0 or len({r["slice"] for r in parts if r["conv_id"] == 5}) > 1
    monkeypatch.setattr(chat, "CHUNK", 100)
    monkeypatch.setattr(chat, "PART_TOKENS", 50)
    assert _got(spark, codec, rows) == _expected(rows)


def test_tokens_masks_and_text(spark, codec):
    rows = [(1, 0, "system", "be [INST] kind"), (1, 1, "user", "</s>"), (1, 2, "assistant", "fine <s>")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    parts = chat.assemble(df, codec)
    assert [r["text"] for r in chat.formatted(parts, codec).collect()] == ["<<SYS>>system<</SYS>>be [\\INST] kind</s><s>[INST]<\\/s>[/INST]fine <\\s></s>"]
    row = parts.first()
    ids, mask = np.array(row["token_ids"]), np.array(row["loss_mask"])
    assert codec.decode(ids[mask == 1]) == "fine <\\s>"
    assert (ids >= codec.mark(0)).sum() == 2 + 1 + 3 + 1 and ids.max() < codec.mark(len(chat.MARKS))


def test_escape_is_reversible():
    rng = random.Random(10)
    for _ in range(5000):
        text = _texts(rng)
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(m in escaped for m in chat.MARKS)


def test_mask_by_prefix_sums():
    ids, mask = chat.assembled([([1], False), ([], True), ([2, 3], True), ([4], True), ([5], False), ([6], True)])
    assert ids.tolist() == [1, 2, 3, 4, 5, 6] and mask.tolist() == [0, 1, 1, 1, 0, 1]
    assert len(chat.assembled([])[0]) == 0


def test_empty_table(spark, codec):
    assert _got(spark, codec, []) == {}
