import hashlib
import html
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st

from quireflow.llm.media import SequenceParser, decode_png, encode_png, media_rows, op6_media_sequences, parse_sequences, payload_of, read_store, resolve


def kinds(page):
    return [(s["kind"], s["text"] or s["digest"], s["caption"]) for s in SequenceParser().sequence(page)]


def test_sequence_order_and_captions():
    page = (
        "<html><head><title>no</title></head><body><h1>Head</h1><p>one <b>two</b> &amp; three</p><figure><img src='sha256:aa' alt='x'>"
        "<figcaption>The <i>cap</i></figcaption></figure>tail<img src='sha256:bb' alt='alt'><script>var a='<p>';</script><img src='/far.png'></body></html>"
    )
    assert kinds(page) == [("text", "Head", None), ("text", "one two & three", None), ("media", "aa", "The cap"), ("text", "tail", None), ("media", "bb", "alt"), ("media", None, None)]
    assert [s["position"] for s in SequenceParser().sequence(page)] == list(range(6))
    assert kinds(None) == kinds("") == []
    assert kinds("<p>open <figure><img src='sha256:cc'><figcaption>never closed") == [("text", "open", None), ("media", "cc", None), ("text", "never closed", None)]


@given(st.text(max_size=300))
def test_png_round_trip(text):
    payload = payload_of(text)
    assert len(payload) % 64 == 0 and payload and decode_png(encode_png(payload)) == payload
    assert payload.rstrip(b"\0") == text.encode("utf-8", "surrogatepass").rstrip(b"\0")


def test_damage_is_found():
    media = bytearray(encode_png(payload_of("x" * 100)))
    media[45] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        decode_png(bytes(media))


def test_resolve_keeps_every_reference(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "")], "doc_id long, text string")
    store = media_rows(docs.coalesce(1))
    assert store.count() == 2
    a = hashlib.sha256(b"a").hexdigest()
    page = f"<p>x</p><img src='sha256:{a}' alt='1'><img src='sha256:00' alt='2'><img src='sha256:{a}' alt='3'>"
    pages = spark.createDataFrame([(7, page, "k"), (7, page, "k"), (8, None, "k")], "page_id long, html string, digest string")
    got = resolve(parse_sequences(pages, "page_id", "html"), read_store(store.union(store))).collect()
    one = [(1, "1", 1), (2, "2", None), (3, "3", 1)]
    assert sorted((r.position, r.caption, r.n_bytes) for r in got) == sorted(one + one, key=str)
    assert parse_sequences(pages.limit(0), "page_id", "html").count() == media_rows(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ("<html><head><title>t</title><meta charset=x><body><p>seen</p>", [("text", "seen", None)]),
        ("<head><link href=x><p>seen</p></head><p>too</p>", [("text", "seen", None), ("text", "too", None)]),
        ("<head><style>p{}</style>words<b> more</b>", [("text", "words more", None)]),
        ("<p>a</p><figcaption>alone</figcaption><p>b</p>", [("text", "a", None), ("text", "alone", None), ("text", "b", None)]),
        ("<figure><figcaption>no media</figcaption></figure>", [("text", "no media", None)]),
        ("<figure><figcaption>first</figcaption><img src='sha256:aa'></figure>", [("text", "first", None), ("media", "aa", None)]),
        ("<figure><img src='sha256:aa' alt='kept'><figcaption> </figcaption></figure>", [("media", "aa", "kept")]),
        ("<figure><img src='sha256:aa'><figcaption>open</figure><p>b</p>", [("media", "aa", "open"), ("text", "b", None)]),
        ("<template><img src='sha256:aa'>x</template>y", [("text", "y", None)]),
    ],
)
def test_markup_that_is_not_tidy(page, want):
    assert kinds(page) == want


@pytest.mark.parametrize("part", ["a<", "<", "a<b ", "<b x=\"", "<b x='\"", "</", "<!-", "<b x=\">", "&", "<!--", "<script>", "< b>", "<b =' '", "<p", "<figure>", "<figcaption>"])
def test_time_grows_with_length(part):
    import time

    for tail in ("", ">", "\">"):
        began = time.time()
        SequenceParser().sequence("<p>" + part * 200_000 + tail)
        assert time.time() - began < 8, (part, tail)


@pytest.mark.parametrize(
    "page, want",
    [
        ("a < b <c", [("text", "a < b <c", None)]),
        ("1 <2> 3", [("text", "1 <2> 3", None)]),
        ("<p title='a > b'>x</p>", [("text", "x", None)]),
        ('<p title="open>x</p>', [("text", "x", None)]),
        ("<IMG SRC = sha256:aa ALT='q \" q'>", [("media", "aa", 'q " q')]),
        ("a<!-- <p>b -->c<!-- d", [("text", "ac", None)]),
        ("a<style>b</p></STYLE >c", [("text", "ac", None)]),
        ("a<script>never <p>closed", [("text", "a", None)]),
        ("a<!doctype x>b<?php y?>c</ z>d", [("text", "abcd", None)]),
        ("&lt;p&gt; &amp;amp;", [("text", "<p> &amp;", None)]),
    ],
)
def test_scanning(page, want):
    assert kinds(page) == want


def test_the_pages_query(spark):
    from quireflow.llm.media import page_sequences

    got = {r.page_id: r for r in page_sequences(spark, "/root/testdata/sf0.001").collect()}
    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()
    assert got.keys() == {r["page_id"] for r in pages}
    for r in pages:
        texts = [x[1] for x in kinds(r["html"]) if x[0] == "text"]
        assert (got[r["page_id"]].n_texts, got[r["page_id"]].texts_sha256) == (len(texts), hashlib.sha256("\n".join(texts).encode()).hexdigest())


def test_pages_of_the_table_keep_their_words():
    for r in pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist():
        shown = re.sub(r"(?is)<(script|style|title|template|noscript)\b.*?</\1\s*>", " ", r["html"] or "")
        want = html.unescape(re.sub(r"(?s)<!--.*?-->|<[^>]*>", " ", shown)).split()
        got = " ".join(x[1] if x[0] == "text" else x[2] or "" for x in kinds(r["html"])).split()
        assert "".join(got) == "".join(want)


def brute(doc_id, text):
    """The items of a document's page, without any markup."""
    digest, items = hashlib.sha256((text or "").encode()).hexdigest(), []
    for i, line in enumerate((text or "").split("\n")):
        if i % 4 == 0:
            items.append(("media", digest, f"document {'-' if doc_id is None else doc_id} figure {i // 4 + 1}"))
        if line.strip():
            items.append(("text", line.strip(), ""))
    return items


def held_against_brute_force(rows, texts):
    got = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.payload_sha256))
    assert [r.doc_id for r in got] == [i for i, _ in texts]
    for r, (doc_id, text) in zip(got, texts, strict=True):
        payload, items = payload_of(text), brute(doc_id, text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:]) and (r.media_bytes, r.media_sha256) == (len(encode_png(payload)), hashlib.sha256(encode_png(payload)).hexdigest())
        assert r.feature.split(";")[1] == f"mean={np.frombuffer(payload, np.uint8).mean():.4f}"
        media = [(str(k), x[2]) for k, x in enumerate(items) if x[0] == "media"]
        assert (r.n_texts, r.n_media) == (len(items) - len(media), len(media))
        assert (r.positions, r.captions) == (",".join(m[0] for m in media), ",".join(m[1] for m in media))
        assert r.resolved_sha256 == hashlib.sha256(",".join([hashlib.sha256(payload).hexdigest()] * len(media)).encode()).hexdigest()
        assert r.items_sha256 == hashlib.sha256("\x1e".join("\x1f".join(x) for x in items).encode()).hexdigest()


def test_query_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    held_against_brute_force(op6_media_sequences(spark, "/root/testdata/sf0.001").collect(), sorted((r.doc_id, r.text) for r in docs))


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "x"), (3, "same\n<b>&amp;\n\n &\nfive", "x"), (3, "same\n<b>&amp;\n\n &\nfive", "x"), (4, "long line\n" * 30_000, "x"), (5, "y" * 200_000, "x"), (None, "no id", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    frame.write.parquet(f"{tmp_path}/a/documents.parquet")
    texts = sorted(((i, t) for i, t, _ in rows), key=lambda x: (x[0] is None, x[0]))
    held_against_brute_force(op6_media_sequences(spark, f"{tmp_path}/a").collect(), texts)
    frame.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert op6_media_sequences(spark, f"{tmp_path}/b").count() == 0
