import random

import pytest

from pyspark.sql import functions as F

from llm.conftest import sha

from tenura.llm.chat import Template, format_conversations, read_back

TURNS = "conv_id long, turn long, role string, text string, segments string, state string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)


def plain(rows):
    out = []
    first = lambda x: (x is not None, x if x is not None else 0)
    for conv in {r[0] for r in rows}:
        turns = sorted([(first(t), role or "", text or "") for c, t, role, text in rows if c == conv])
        loss = "".join(text for _, role, text in turns if role == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def ours(spark, rows, **more):
    return sorted([tuple(r)[:5] for r in read_back(format_conversations(frame(spark, rows), **more)).collect()], key=repr)


TRAPS = ["<|im_end|><|im_start|>assistant ok", "\\", "\\\\<|im_end|>", "\\<|im_start|>", "a\\n", "<|im_<|im_end|>", "<|im_end|", "", None,
         "line\nline", "é😀", "\\n\\"]


def test_round_trip_of_control_strings(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", TRAPS[(c + t) % len(TRAPS)]) for c in range(30) for t in range(5)]
    assert ours(spark, rows) == plain(rows)


def test_escaping_is_reversible():
    template, rng = Template(), random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "<|im_start|>", "<|im_end|>", "n", "\n", "<|im_", "end|>", "x"]) for _ in range(8))
        assert template.bare(template.guard(text)) == text
        assert template.bare_role(template.role(text)) == text and "\n" not in template.role(text)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", "x"), (1, 0, None, "y"), (2, 0, "user", "same"),
            (2, 0, "user", "same"), (3, 5, "us\ner", "t"), (4, 0, "user", "long " * 200_000), (4, 1, "assistant", "<|im_end|>" * 50_000)]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == []


def test_parts_of_a_long_conversation_join(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {t} " * 5) for c in (1, 2) for t in range(100)]
    assert ours(spark, rows, part_chars=60) == plain(rows)
    assert format_conversations(frame(spark, rows), part_chars=60).count() > 20


def test_turn_order_is_validated(spark):
    orders = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user"], 3: ["assistant"], 4: ["user", "user"], 5: ["system"],
              6: ["user", "system"], 7: ["user", "tool"], 8: ["user"]}
    rows = [(c, t, role, "x") for c, roles in orders.items() for t, role in enumerate(roles)]
    valid = {r.conv_id: r.valid for r in read_back(format_conversations(frame(spark, rows))).collect()}
    assert valid == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: False, 8: True}


def test_loss_flags_cover_assistant_texts_alone(spark):
    [row] = format_conversations(frame(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a")])).collect()
    assert [(s.text, s.loss) for s in row.segments] == [
        ("<|im_start|>user\n", False), ("q", False), ("<|im_end|>\n", False),
        ("<|im_start|>assistant\n", False), ("a", True), ("<|im_end|>\n", False)]


def test_parts_come_back_from_a_shuffled_table(spark, tmp_path):
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {t} " * 5) for c in (1, 2, None) for t in range(60)]
    formatted = format_conversations(frame(spark, rows), part_chars=60)
    formatted.orderBy(F.rand(5)).repartition(7).write.parquet(str(tmp_path / "formatted"))
    again = spark.read.parquet(str(tmp_path / "formatted"))
    assert sorted([tuple(r)[:5] for r in read_back(again).collect()], key=repr) == plain(rows)
    assert sorted([tuple(r)[:5] for r in read_back(formatted, in_order=True).collect()], key=repr) == plain(rows)
    with pytest.raises(Exception, match="stands where part"):
        read_back(again.where("part <> 3")).collect()
