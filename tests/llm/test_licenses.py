import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quireflow.llm.licenses import BASE, TEMPLATES, Automaton, Scanner, op1_license_scan, scan_licenses


def as_regex(template):
    """The template as a regular expression over '<word> ' sequences: an independent matcher."""
    out = []
    for k, part in enumerate(re.split(r"<<(opt|/opt|var \d+)>>", template)):
        if k % 2 == 0:
            out += [re.escape(w) + " " for w in part.lower().split()]
        else:
            out.append({"opt": "(?:", "/opt": ")?"}.get(part) or rf"(?:\S+ ){{0,{part[4:]}}}")
    return re.compile("".join(out))


def brute(template, words):
    """Longest match from every start, by trying every length."""
    found, pattern = {}, as_regex(template)
    for at in range(len(words)):
        for n in range(len(words) - at, 0, -1):
            if pattern.fullmatch("".join(w + " " for w in words[at : at + n])):
                found[at] = n
                break
    return found


TOY = {"a": "x <<opt>>y z<</opt>> w", "b": "x y <<var 2>> w", "c": "w <<opt>>x<</opt>> <<opt>>y<</opt>> <<var 1>>", "d": "z z <<opt>>x <<var 1>> y<</opt>> z"}


@given(st.lists(st.sampled_from("wxyz"), max_size=14))
@settings(max_examples=300, deadline=None)
def test_automata_match_brute_force(words):
    scanner = Scanner(TOY, {"x y": "p", "x x": "q"})
    n, found = scanner.scan(" ".join(words).upper())
    assert n == len(words)
    for label, template in TOY.items():
        assert {s: k for a, s, k, base in found if a == label and not base} == brute(template, words)
    pairs = [tuple(words[i : i + 2]) for i in range(len(words) - 1)]
    assert sorted(s for a, s, _, base in found if base) == [i for i, p in enumerate(pairs) if p in (("x", "y"), ("x", "x"))]


def test_templates_compile_and_match_themselves():
    for label, template in TEMPLATES.items():
        plain = re.sub(r"<<[^>]*>>", " ", template)
        _, found = Scanner({label: template}, BASE).scan(plain)
        assert any(a == label for a, *_ in found), label


def test_template_must_begin_with_wording():
    with pytest.raises(ValueError):
        Automaton("<<var 2>> license")


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "All Rights\tReserved! " * 3, 0), (3, "All Rights\tReserved! " * 3, 0), (4, "x " * 50_000 + "cc-by", 0), (5, "Released under the MIT License.", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    got = {(r.doc_id, r.n_words, tuple((m.label, m.first_word) for m in r.matches)) for r in scan_licenses(df).collect()}
    assert got == {
        (1, 0, ()),
        (2, 0, ()),
        (3, 9, (("reserved", 0), ("reserved", 3), ("reserved", 6))),
        (4, 50_002, (("cc-by", 50_000),)),
        (5, 5, (("mit-notice", 0),)),
    }
    assert scan_licenses(df.limit(0)).count() == 0


def test_query(spark, tmp_path):
    spark.createDataFrame([(1, "Copyright (c) A B. All rights reserved. All rights reserved"), (2, "none")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    one, two = op1_license_scan(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert (one.n_words, one.n_base, one.first_word, one.last_word, one.base_labels, one.labels, one.score) == (10, 2, 4, 7, "reserved", "copyright-notice,reserved", 1.0)
    assert (two.n_base, two.first_word, two.base_labels, two.labels, two.score) == (0, None, "", "", 0.0)


def test_long_texts_take_time_in_proportion():
    scanner = Scanner(TEMPLATES, BASE)
    took = []
    for n in (20_000, 200_000):
        began = time.process_time()
        n_words, found = scanner.scan("cc by " * n)
        took.append(time.process_time() - began)
        assert n_words == 2 * n and [m[1] for m in found] == list(range(0, 2 * n, 2))
    assert took[1] < 40 * max(took[0], 0.02)
