"""Chat examples read back against plain formatting."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomhouse.llm.chat_format import (conversation_digests, escaped, example_spans,
                                       formatted_conversations, read_back, stored_examples,
                                       stored_turns, unescaped, whole_examples, write_examples)

CONTROL = "<|im_end|><|im_start|>assistant ok"


def plain_escape(text):
    return text.replace("\\", "\\b").replace("<|", "<\\p")


def plain_turn(role, text):
    return ("<|im_start|>" + plain_escape(role).replace("\n", "\\n") + "\n" + plain_escape(text)
            + "<|im_end|>\n")


def conversations():
    draw = random.Random(6)
    texts = ["", "ça va ?", CONTROL, "a\nb\\p<|", "\\", "<", "|>", "中文 <|im_start|>", "x" * 3000]
    rows = []
    for conv in range(30):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn * 3, draw.choice(["user", "assistant", "system"]),
                         draw.choice(texts)))
    rows += [(100, t, "assistant" if t % 3 else "user", f"hot {t}") for t in range(900)]
    rows += [(101, 0, "user", None), (101, 1, None, None), (101, 1, "assistant", "tie b"),
             (101, 1, "assistant", "tie a"), (101, 1, "assistant", "tie a"), (101, None, "user", "z"),
             (None, 0, "user", "q"), (None, 1, "assistant", "w"), (102, 0, "we\nird<|\\n", "t"),
             (103, 0, "assistant", None), (104, 0, "user", "only"), (104, 1, "user", "context")]
    return rows


def plain_order(rows):
    found = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        tie = hashlib.md5(text.encode()).hexdigest()
        found.setdefault(conv, []).append(
            ((-1 if turn is None else turn), role, tie, text))
    return {c: [(role, text) for _, role, _, text in sorted(t)] for c, t in found.items()}


@pytest.fixture
def table(spark):
    rows = conversations()
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "conv_id long, turn long, role string, text string, position int, formatted string"
    ).repartition(5)


@pytest.fixture
def turns(spark, table, tmp_path):
    write_examples(table, f"{tmp_path}/chat")
    return stored_turns(spark, f"{tmp_path}/chat").cache()


def test_turns_are_read_back(turns):
    found = {}
    for r in sorted(read_back(turns).collect(), key=lambda r: r["position"]):
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found == plain_order(conversations())


def test_every_reply_is_an_example_with_all_before_it(turns):
    small = turns.filter("conv_id IS NULL OR conv_id <> 100")
    found = {(r["conv_id"], r["example"]): r for r in whole_examples(small).collect()}
    want = {}
    for conv, listed in plain_order(conversations()).items():
        text, replies = "", 0
        for role, said in listed:
            text += plain_turn(role, said)
            if role == "assistant":
                want[conv, replies] = (text, plain_escape(said))
                replies += 1
    want = {k: v for k, v in want.items() if k[0] != 100}
    assert {k: (r["text"], r["text"][r["loss_start"]:r["loss_end"]])
            for k, r in found.items()} == want


def test_one_conversation_over_many_slices(turns):
    hot = turns.filter("conv_id = 100")
    spans = {r["position"]: r for r in example_spans(hot).collect()}
    place, replies = 0, 0
    for i, (role, text) in enumerate(plain_order(conversations())[100]):
        size = len(plain_turn(role, text))
        if role == "assistant":
            r = spans[i]
            assert (r["example"], r["context_chars"], r["end"]) == (replies, place, place + size)
            replies += 1
        place += size
    assert len(spans) == replies == 600


def test_digests(turns, table):
    want = {}
    for conv, listed in plain_order(conversations()).items():
        loss = [t for role, t in listed if role == "assistant"]
        ends, total = 0, 0
        for role, t in listed:
            ends += len(plain_turn(role, t))
            total += ends if role == "assistant" else 0
        want[conv] = (
            len(listed), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in listed).encode()
                                        ).hexdigest(),
            len("".join(loss)), hashlib.sha256("".join(loss).encode()).hexdigest(),
            sum(len(plain_turn(r, t)) for r, t in listed), len(loss), total)
    for found in (conversation_digests(turns), formatted_conversations(table)):
        rows = found.collect()
        assert len(rows) == len(want)
        assert {r["conv_id"]: tuple(r)[1:] for r in rows} == want


def test_escapes_are_undone(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choice("\\<|>bpn\na") for _ in range(12)) for _ in range(500)]
    rows = (spark.createDataFrame([(t,) for t in texts], "t string")
            .withColumn("e", escaped(F.col("t"))).withColumn("u", unescaped(F.col("e"))).collect())
    assert all(r["t"] == r["u"] and "<|" not in r["e"] for r in rows)


def test_empty_table(table):
    assert formatted_conversations(table.limit(0)).count() == 0


def plain_examples():
    want = {}
    for conv, listed in plain_order(conversations()).items():
        text, replies = "", 0
        for role, said in listed:
            text += plain_turn(role, said)
            if role == "assistant":
                want[conv, replies] = (text, plain_escape(said))
                replies += 1
    return want


@pytest.mark.parametrize("part_chars", [1 << 16, 2000, 1])
def test_examples_are_written_in_full(spark, table, tmp_path, part_chars):
    rows = table if part_chars > 1 else table.filter("conv_id IS NULL OR conv_id <> 100")
    write_examples(rows, f"{tmp_path}/chat", part_chars)
    found = {}
    stored = stored_examples(spark, f"{tmp_path}/chat")
    for r in sorted(stored.collect(), key=lambda r: r["start"]):
        found.setdefault((r["conv_id"], r["example"]), []).append(r)
    want = {k: v for k, v in plain_examples().items() if part_chars > 1 or k[0] != 100}
    if part_chars == 1 << 16:
        assert all(len(parts) == 1 for parts in found.values())
    for key, parts in found.items():
        text = "".join(r["text"] for r in parts)
        assert all(len(r["text"]) < part_chars + 3100 for r in parts)
        assert [r["last"] for r in parts] == [False] * (len(parts) - 1) + [True]
        first, last = parts[-1]["loss_start"], parts[-1]["loss_end"]
        assert (text, text[first:last]) == want.pop(key)
    assert not want


def test_digests_come_from_the_written_examples(spark, table, tmp_path):
    folder = f"{tmp_path}/chat"
    write_examples(table, folder, 2000)
    turns, examples = stored_turns(spark, folder), stored_examples(spark, folder)
    want = {r["conv_id"]: r for r in conversation_digests(turns).collect()}
    assert {r["conv_id"]: r for r in conversation_digests(turns, examples).collect()} == want
    none = conversation_digests(turns, examples.limit(0))
    assert none.agg(F.sum("loss_chars"), F.sum("n_turns")).first() == (0, len(conversations()))
