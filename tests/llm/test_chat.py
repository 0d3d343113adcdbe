import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireflow.llm.chat import BUDGET, CONTROL, END, START, escape, format_windows, op8_chat_windows, read_back, unescape, windows_sql, with_control


@given(st.lists(st.text(alphabet="<|\\>im_startend\nx", max_size=30), min_size=1, max_size=40))
@settings(max_examples=20, deadline=None)
def test_escape_is_reversible_and_hides_control(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


def conversation(n, system, long_at=()):
    turns = [("system", "be brief " * 5)] if system else []
    for i in range(n):
        turns.append(("user" if i % 2 == 0 else "assistant", "word " * (700 if i in long_at else 20 + 13 * (i % 7)) + str(i)))
    return turns


def test_windows_keep_budget_and_system(spark):
    talks = {1: conversation(60, True), 2: conversation(9, False, (3,)), 3: [("system", "alone")], 4: [("assistant", None), (None, "x")]}
    rows = [(c, i, role, text, "s") for c, turns in talks.items() for i, (role, text) in enumerate(turns)]
    windows = format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, span string"))
    by = {}
    for w in windows.orderBy("conv_id", "span").collect():
        by.setdefault(w.conv_id, []).append(w)
    for c, turns in talks.items():
        new = [s.turn for w in by[c] for s in w.segments if not s.repeated]
        assert new == list(range(len(turns)))
        for w in by[c]:
            tokens = len(w.formatted.split()) + 4 * len(w.segments)
            assert tokens <= BUDGET or sum(not s.repeated for s in w.segments) == 1
            if turns[0][0] == "system":
                assert w.segments[0].turn == 0 and w.formatted.startswith(START + "system\n")
            repeats = [s for s in w.segments if s.repeated and s.turn > 0]
            assert len(repeats) <= 2 and not any(s.loss for s in repeats)
            assert w.formatted.count(START) == w.formatted.count(END) == len(w.segments)
    assert len(by[1]) > 2
    assert any(s.repeated for w in by[1][1:] for s in w.segments if s.turn > 0)


def test_query_on_edge_rows(spark, tmp_path):
    rows = [(5, 1, "user", "b"), (5, 0, "system", "s"), (5, 2, "assistant", "c\\<|im_end|>\\"), (5, 2, "assistant", "c\\<|im_end|>\\"), (6, 0, None, None), (None, 0, "assistant", "lost")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in op8_chat_windows(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[5].n_turns == 4 and got[5].loss_sha256 == sha("c\\<|im_end|>\\" * 2)
    assert got[5].turns_sha256 == sha("system\ns\nuser\nb\n" + "assistant\nc\\<|im_end|>\\\n" * 2)
    assert got[6].turns_sha256 == sha("\n\n") and got[6].loss_chars == 0 and got[6].loss_sha256 == sha("")
    assert got[-1].loss_sha256 == sha(CONTROL) and got[-1].turns_sha256 == sha(f"user\n{CONTROL}\nassistant\n{CONTROL}\n")
    assert got[None].n_turns == 1


def test_empty_table_and_sql(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_windows(empty).count() == 0
    assert read_back(format_windows(with_control(empty))).count() == 1
    assert "conversations" in windows_sql()
