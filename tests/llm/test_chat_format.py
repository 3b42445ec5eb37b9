import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halocline.llm.chat_format import TEMPLATE, Codec, Escaper, default_vocabulary, digests, format_conversations, op11_chat_format, read_back

CODEC = Codec(TEMPLATE, default_vocabulary())
PIECES = [*TEMPLATE.controls, "\\", "<", "[", "INST]", "s>", " ", "\n", "é", "日", "🙂", "ok", "<|endoftext|>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control(text):
    e = Escaper(TEMPLATE)
    there = e.escape(text)
    assert e.unescape(there) == text
    assert not any(c in there for c in TEMPLATE.controls)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]))
def test_turn_round_trip(text, role):
    segments = CODEC.turn(role, text)
    assert (np.concatenate([segments[1], segments[3]]) < CODEC.first).all()
    back, content, chars = CODEC.read(np.concatenate(segments))
    assert (back, content) == (role, text)
    assert chars >= len(text) + len(CODEC.strings[int(segments[0][0])])


def test_long_texts_are_whole():
    for text in (" " * 1_200_000 + "a", "ab" * 300_000, "\\" * 200_000, "[" + "\\" * 100_000 + "INST]"):
        assert CODEC.read(np.concatenate(CODEC.turn("user", text)))[1] == text


def plain(rows):
    """The contract in Python; characters are counted by writing the text out."""
    e = Escaper(TEMPLATE)
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns = [x[2:] for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        written = ""
        for r, t in turns:
            a, b = TEMPLATE.roles.get(r, ("<|role|>" + e.escape(r) + "<|text|>", "<|end|>"))
            written += a + e.escape(t) + b
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        out[conv] = (len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(written))
    return out


def fixture():
    rnd = random.Random(3)
    text = lambda: rnd.choice([None, "", "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(40)))])
    role = lambda: rnd.choice(["user", "assistant", "assistant", "system", "tool", None, "[INST]"])
    rows = [(c, t, role(), text()) for c in range(30) for t in range(rnd.randrange(1, 6))]
    rows += [(100, t, role(), text()) for t in range(300)]  # one conversation over several tasks
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (5, None, "assistant", "no turn"), (6, 0, "user", "tie"), (6, 0, "user", "tie"), (6, 0, "assistant", "tie")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture
def many_tasks(spark):
    """Small inputs stay in as many tasks as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_brute_force(spark, many_tasks):
    rows = fixture()
    convs = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part int, ids string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in digests(read_back(format_conversations(convs))).collect()}
    assert got == plain(rows)


def test_masks_and_places_over_several_tasks(spark, many_tasks):
    rows = fixture()
    convs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    turns = format_conversations(convs).orderBy("conv_id", "part", "place").collect()
    assert len({r.part for r in turns if r.conv_id == 100}) > 1
    at = {}
    for r in turns:
        assert r.token_start == at.get(r.conv_id, 0) and len(r.ids) == len(r.loss)
        at[r.conv_id] = r.token_start + len(r.ids)
        role, text, _ = CODEC.read(np.array(r.ids))
        learned = np.flatnonzero(r.loss)
        assert len(learned) == (len(r.ids) - 2 if role == "assistant" else 0)
        assert all(r.ids[i] < CODEC.first for i in learned)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(read_back(format_conversations(none))).collect() == []


def test_added_conversation(spark):
    row = op11_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars) == (2, len(said))
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
