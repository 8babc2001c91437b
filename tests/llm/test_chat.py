import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from ratingloom.llm.chat import (
    END, END_ID, START, START_ID, assemble, escape, escape_role, loss_mask, read_back, unescape, unescape_role,
)

SCHEMA = "conv_id long, turn long, role string, text string"
TEXT = st.text(alphabet=st.sampled_from(list("<|\\>im_ endstart\nn") + ["é", "🙂"]), max_size=40)


@given(TEXT)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unescape_role(escape_role(text)) == text and "\n" not in escape_role(text)


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    result = []
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        formatted = "".join(f"{START}{escape_role(r)}\n{escape(t)}{END}\n" for *_, r, t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        result.append((conv, len(turns), digest(said), len(learned), digest(learned), len(formatted)))
    return sorted(map(str, result))


ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", f"{END}{START}assistant ok"), (1, 2, "user", None), (1, 3, None, ""),
    (2, 1, "assistant", "second"), (2, 0, "assistant", "first "), (2, 1, "assistant", "second"), (2, None, "user", "?"),
    (None, 0, "assistant", "no conversation"), (3, 0, "a\nb\\n<|", "\\<\\|x"), (4, 0, "assistant", "ä🙂 " * 4000),
]


def test_round_trip_on_messy_rows(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'own' as position", "'own' as ids")
    got = read_back(assemble(frame)).drop("n_tokens").collect()
    assert sorted(str(tuple(r)) for r in got) == expected(ROWS)


def test_a_long_conversation(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} of many") for i in range(3000)] + ROWS
    got = read_back(assemble(spark.createDataFrame(rows, SCHEMA))).drop("n_tokens").collect()
    assert sorted(str(tuple(r)) for r in got) == expected(rows)


def test_reserved_ids_stand_only_where_they_are_spliced(spark):
    for r in assemble(spark.createDataFrame(ROWS, SCHEMA)).collect():
        assert r.ids.count(START_ID) == 1 and r.ids.count(END_ID) == 1
        assert r.token_from < r.loss_from <= r.loss_to < r.token_from + len(r.ids)


def test_mask_is_a_prefix_sum():
    assert loss_mask(6, 10, [(11, 13), (14, 15)]).tolist() == [0, 1, 1, 0, 1, 0]
    assert loss_mask(0, 0, []).tolist() == [] and loss_mask(2, 0, [(1, 1)]).dtype == np.int64


def test_empty_table(spark):
    assert read_back(assemble(spark.createDataFrame([], SCHEMA))).count() == 0
