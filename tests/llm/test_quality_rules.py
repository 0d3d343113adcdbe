import re
from collections import Counter

from quireflow.llm.quality_rules import RULES, Rule, apply_rules, op10_quality_rules


def brute(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_edge_rows_against_brute_force(spark):
    texts = [None, "", " \t\n", "a", "a b c", "a b c a b c", "x x x x", "one two\none two\n\n \none two", "# * é|<\x0b>\r\n漢字 𝄞 & %", "the cat sat on a mat " * 30, "the cat and " + " ".join(f"w{i}" for i in range(30_000)) + " the cat and"]
    rows = [(i, t, "x", "y") for i, t in enumerate([*texts, texts[-1]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, _mwords string, measures string")
    got = {r.doc_id: r for r in apply_rules(df).collect()}
    for i, t, *_ in rows:
        m = got[i].measures_
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed) == brute(t)
        assert not (m.base_failed and m.kept) and (got[i]._mwords, got[i].measures) == ("x", "y")
    assert apply_rules(df.limit(0)).count() == 0


def test_rules_are_a_table(spark):
    text = "the cat sat on the mat and looked at me for a while " + " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert apply_rules(df).first().measures.kept
    assert not apply_rules(df, rules=(*RULES, Rule("n_words", most=60))).first().measures.kept


def test_one_projection_without_user_functions(spark):
    plan = op10_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)
