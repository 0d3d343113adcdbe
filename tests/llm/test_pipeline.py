import random
from collections import Counter, defaultdict

import corpus_pipeline as cp
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quireflow.llm import common
from quireflow.llm.common import stored
from quireflow.llm.language import learn, predict
from quireflow.llm.quality_rules import apply_rules
from quireflow.llm.simhash import sketch, sketch_radius

from .test_line_dedup import alike, norm
from .test_quality_rules import brute as brute_quality
from .test_simhash import groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 6000").select(*COLUMNS)
    extra = [(9001, None, None, "x", 0), (9002, "12 %% 34", "en", "x", 8), (9003, docs.first().text, "en", "x", 1)]
    docs = stored(docs.unionByName(spark.createDataFrame(extra, docs.schema)), "docs")
    rows = {r.doc_id: r for r in docs.collect()}
    stage = {n: lambda s, d, at, f=f, n=n: stored(f(s, d, at), n) for n, f in cp.STAGES}  # as the driver runs them

    found = {r.doc_id: r.language for r in predict(docs, learn(docs)).collect()}
    one = stage["language_id"](spark, docs, "")
    assert one.columns == COLUMNS
    ids = {r.doc_id for r in one.collect()}
    assert ids == {i for i, x in found.items() if x.lang != "und" and x.score >= 0.4} and not ids & {9001, 9002} and len(ids) > 0.8 * len(rows)

    two = stage["quality_rules"](spark, one, "")
    kept = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == COLUMNS and kept.keys() <= {i for i in ids if not brute_quality(rows[i].text)[-1]} and len(kept) > 0.5 * len(ids)

    three = stage["line_dedup"](spark, two, "")
    got = {r.doc_id: r for r in three.collect()}
    want = {i: r.text for i, r in got.items()}
    left, before = Counter(), [x for t in kept.values() for x in t.split("\n") if norm(x)]
    for i, t in kept.items():
        rest = iter(t.split("\n"))
        lines = want.get(i, "").split("\n") if i in want else []
        assert all(x in rest for x in lines)  # in order, and nothing else
        left.update(x.lower().strip(" ") for x in lines if norm(x))
    assert three.columns == COLUMNS and max(left.values()) == 1  # no line stands twice
    assert all(r.n_chars == len(r.text) and r.text.split() for r in got.values())
    for gone in {x.lower().strip(" ") for x in before} - left.keys():  # each line that went has one that it is alike to
        words = set(norm(gone).split())
        near = (x for x in before if x.lower().strip(" ") != gone and abs(len(x) - len(gone)) <= 0.4 * len(gone) and 2 * len(words & set(norm(x).split())) >= len(words) - 2)
        assert any(alike(norm(gone), norm(x)) for x in near)

    four = stage["near_dedup"](spark, three, "")
    made = {i: sketch(t) for i, t in want.items()}
    order, apart = sorted(made), lambda a, b: int(np.bitwise_count((made[a][0] ^ made[b][0]).view(np.uint64)).sum())
    root = groups(order, [(a, b) for k, a in enumerate(order) for b in order[:k] if apart(a, b) <= sketch_radius() and (made[a][1] == made[b][1]).any()])
    assert four.columns == COLUMNS and {r.doc_id for r in four.collect()} == set(root.values())

    five = defaultdict(int)
    for r in stage["packing"](spark, four, "").collect():
        five[r.doc_id] += r.length
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert five == {i: len(tok.encode(want[i], add_special_tokens=False).ids) + 1 for i in set(root.values())}


def test_run_and_empty_table(spark, tmp_path):
    names = [n for n, _ in cp.STAGES]
    assert len(names) == 5 and cp.ORACLE_SQL is None
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    whole = cp.run(spark, "/root/testdata/sf0.001")
    sizes = np.array([r["sum(length)"] for r in whole.groupBy("sequence_id").sum("length").collect()])
    assert sizes.max() == 2048 and (sizes & (sizes - 1) == 0).all()


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    words = "the cat and the dog of the house went to the river for water with a friend who was from another town and is not at home".split()
    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(words) + rng.choice(["", "", "er", "ing"]) for _ in range(120)) + "."
    a, b, c = text(), text(), text()
    kind = "doc_id long, text string, lang string, source string, n_chars long, fp string, measures string, language string, removed_lines string, _text_hash string, _kept string"
    rows = [(1, a, "en"), (1, a, "en"), (1, b, "en"), (2, a, "en"), (3, None, "en"), (4, "", None), (None, c, "en"), (5, (text() + "\n") * 400, "en"), (6, text() + "\n" + text(), "en")]
    docs = spark.createDataFrame([(i, t, x, "s", len(t or ""), *"uvwxyz") for i, t, x in rows], kind)
    before = docs
    for name, stage in cp.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), name)
        assert docs.columns == before.columns
    left = [(r.doc_id, r.text, r.fp, r.measures, r.language, r.removed_lines, getattr(r, "_text_hash"), getattr(r, "_kept")) for r in docs.collect()]  # noqa: B009
    assert {x[2:] for x in left} == {tuple("uvwxyz")}
    assert sorted((x[0] or 0, x[1]) for x in left if x[0] in (1, 2, None)) == sorted([(0, c), (1, a), (1, b)])


def test_one_id_with_two_texts_is_two_documents(spark):
    near = dict(cp.STAGES)["near_dedup"]
    one, two = " ".join(f"word{i}" for i in range(80)), " ".join(f"other{i}" for i in range(80))
    rows = [(7, one, "x"), (7, two, "x"), (7, one, "y"), (8, two, "x"), (None, one, "x"), (None, one, "x"), (9, None, "x"), (10, "", "x")]
    got = near(spark, spark.createDataFrame(rows, "doc_id long, text string, _text_hash string"), "").select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(0, one), (0, one), (7, one), (7, two), (9, "")])
    assert near(spark, spark.createDataFrame([], "doc_id long, text string"), "").count() == 0


def test_quality_stage_writes_no_copy(spark):
    """A copy of the documents would lie on disk through all later stages."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = set(common._kept)
    out = dict(cp.STAGES)["quality_rules"](spark, docs, "")
    got = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns and got == {r.doc_id for r in apply_rules(docs).collect() if r.measures.kept} and got
    assert set(common._kept) == before
