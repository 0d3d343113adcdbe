"""Media columns: interleaved document sequences.

A page's HTML is parsed into one ordered array of structs: text segments and media references, the latter with their
position, digest and caption (a figure's caption, else the image's alternative text). Payloads are written to a store in shared
storage, a row per digest and writing task at most; what is read back from it is joined to the references by digest, so every
reference keeps its position and caption. The stored form is a lossless 8-bit grey-scale PNG with rows of 64 samples.

Edge cases: null or empty HTML gives an empty sequence; a reference without a digest, or whose digest the store lacks,
keeps its place with null payload fields; a head that is never closed ends where a body's element begins, other hidden markup
that never closes ends with the page; a caption outside a figure, or of a figure without media, is text; an empty table gives an empty
result; repeated rows are parsed one by one and share a payload, as do equal texts; pages and texts of any length are read
whole; no order depends on ties, as positions are unique; other columns are left alone. Null payload texts count as empty.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, table

UNIT = 64
SCHEME = "sha256:"
HIDDEN = frozenset({"script", "style", "title", "template", "noscript"})
#: Elements that a head may hold; any other one ends a head that was not closed.
HEAD = HIDDEN | {"head", "html", "meta", "link", "base"}
BLOCKS = frozenset({"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "nav", "footer", "header", "table", "tr", "td", "body", "html", "figure", "pre"})
SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"
_PNG = b"\x89PNG\r\n\x1a\n"  # fixed value of the format


_OPEN, _ATTRIBUTE = re.compile(r"[a-zA-Z][^\s/>]*"), re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_TAG_END = re.compile(r"""=\s*["']|>""")
_RAW = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in ("script", "style")}


class Scanner:
    """Reads markup once, from left to right, and tells tags and text; its time grows with the markup's length alone.

    A tag ends at the first `>` outside a quoted value. What looks like a tag and never ends is text, as is a lone `<`; a comment, script
    or style that never ends reaches to the end.
    """

    def feed(self, html: str) -> None:
        self._s, self._closed = html, {'"': len(html), "'": len(html)}
        at = look = 0  # where the text not yet told begins, and where the next `<` is looked for
        last = html.rfind(">")
        while (j := html.find("<", look)) >= 0:
            after = html[j + 1 : j + 2]
            name = _OPEN.match(html, j + 1) if after.isascii() and after.isalpha() else None
            if html.startswith("<!--", j):
                self._tell(at, j)
                if (end := html.find("-->", j + 4)) < 0:
                    return
                at = look = end + 3
            elif name is None and after not in ("!", "?", "/"):
                look = j + 1
            elif j > last:
                break
            elif name is None:
                self._tell(at, j)
                end = html.find(">", j)
                if after == "/" and (closing := _OPEN.match(html, j + 2)):
                    self.handle_endtag(closing.group().lower())
                at = look = end + 1
            else:
                self._tell(at, j)
                tag, end = name.group().lower(), self._end(name.end(), j)
                self.handle_starttag(tag, html[name.end() : end])
                at = look = end + 1
                if tag in _RAW:
                    if (raw := _RAW[tag].search(html, at)) is None:
                        return
                    at = look = raw.start()
        self._tell(at, len(html))

    def _end(self, pos: int, tag: int) -> int:
        """The place of the `>` that ends a tag whose name ends at pos. That there is one has been seen."""
        s = self._s
        while (m := _TAG_END.search(s, pos)) and m.group() != ">":
            quote, pos = m.group()[-1], m.end()
            # once a quote is not closed, none of its kind behind it is, and quotes of that kind are looked for no more
            close = s.find(quote, pos) if pos < self._closed[quote] else -1
            if close < 0:
                self._closed[quote] = min(self._closed[quote], pos)
            else:
                pos = close + 1
        if m:
            return m.start()
        self._closed = {'"': 0, "'": 0}  # every `>` from here on stands in quotes: they count no more
        return s.find(">", tag)

    def _tell(self, start: int, end: int) -> None:
        if end > start:
            self.handle_data(unescape(self._s[start:end]))


def attributes(told: str) -> dict[str, str]:
    """A tag's attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(told):
        out.setdefault(name.lower(), unescape(values[0] or values[1] or values[2]))
    return out


class SequenceParser(Scanner):
    """Text segments and media references of one page, in order."""

    def __init__(self) -> None:
        self.items: list[list] = []
        self._text: list[str] = []
        self._hidden, self._head = 0, False
        self._figure: list[int] = []
        self._caption: list[str] | None = None

    def _flush(self) -> None:
        text = "".join(self._text).strip()
        self._text.clear()
        if text:
            self.items.append(["text", text, None, None])

    def _end_caption(self) -> None:
        if self._caption is None:
            return
        caption, self._caption = " ".join("".join(self._caption).split()), None
        media = [item for item in self.items[self._figure[-1] :] if item[0] == "media"] if self._figure else []
        for item in media:
            item[3] = caption or item[3]
        if not media:
            self._text.append(caption)
            self._flush()

    def handle_starttag(self, tag: str, told: str) -> None:
        self._head = tag == "head" or (self._head and tag in HEAD)
        if tag in HIDDEN:
            self._hidden += 1
        elif self._hidden or self._head:
            return
        elif tag == "figcaption":
            self._end_caption()
            self._flush()
            self._caption = []
        elif tag in ("img", "video", "audio", "source"):
            self._flush()
            at = attributes(told)
            source = at.get("src") or ""
            digest = source[len(SCHEME) :] if source.startswith(SCHEME) else None
            self.items.append(["media", None, digest, at.get("alt")])
        elif tag in BLOCKS:
            self._flush()
            if tag == "figure":
                self._end_caption()
                self._figure.append(len(self.items))

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN:
            self._hidden = max(0, self._hidden - 1)
        elif tag == "head":
            self._head = False
        elif tag == "figcaption":
            self._end_caption()
        elif tag in BLOCKS:
            self._flush()
            if tag == "figure" and self._figure:
                self._end_caption()
                self._figure.pop()

    def handle_data(self, data: str) -> None:
        if self._head and not self._hidden and data.strip():  # words end a head as well
            self._head = False
        if not self._hidden and not self._head:
            (self._text if self._caption is None else self._caption).append(data)

    def sequence(self, html: str | None) -> list[dict]:
        if html:
            self.feed(html)
            self._flush()
            if self._caption:
                self._text, self._caption = self._caption, None
                self._flush()
        return [{"position": i, "kind": k, "text": t, "digest": d, "caption": c} for i, (k, t, d, c) in enumerate(self.items)]


def parse_sequences(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Per row: id and sequence, the page's ordered text and media structs."""
    id_type = pages.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "h"):
            found = [SequenceParser().sequence(h) for h in batch.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "sequence"])

    plain = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("h"))
    return plain.mapInArrow(run, f"id {id_type}, sequence {SEQUENCE}").withColumnRenamed("id", id_col)


def encode_png(payload: bytes, width: int = UNIT) -> bytes:
    """8-bit grey-scale PNG with a sample per byte; the payload's length is a multiple of the width."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    filtered = np.zeros((len(rows), width + 1), np.uint8)
    filtered[:, 1:] = rows

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return _PNG + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(filtered.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(media: bytes) -> bytes:
    """The samples of a PNG as encode_png writes it; checks each chunk's sum."""
    if media[:8] != _PNG:
        raise ValueError("not a PNG")
    at, width, height, packed = 8, 0, 0, []
    while at < len(media):
        (n,) = struct.unpack(">I", media[at : at + 4])
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a chunk is damaged")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only unfiltered rows are written here")
    return rows[:, 1:].tobytes()


def payload_of(text: str | None) -> bytes:
    """UTF-8 bytes, with zeros up to a positive multiple of the unit."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def media_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(digest, n_bytes, media): the stored form of each text; digest is that of the unpadded bytes. Narrow: no shuffle.

    Copies within a task are merged before anything is encoded.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[str] = set()
        for batch in slices(batches, "t"):
            rows = []
            for d, t in zip(batch.column("digest").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if d not in done:
                    if len(done) >= 1_000_000:  # only saves work; readers merge copies by digest
                        done.clear()
                    done.add(d)
                    rows.append((d, len(t.encode("utf-8", "surrogatepass")), encode_png(payload_of(t))))
            if rows:
                kinds = [pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["digest", "n_bytes", "media"])

    return docs.select(F.sha2(text, 256).alias("digest"), text.alias("t")).mapInArrow(run, "digest string, n_bytes bigint, media binary")


def read_store(store: DataFrame) -> DataFrame:
    """The store (digest, n_bytes, media) read back: a row per digest with digests and features of its payload, taken from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, n, media in zip(*(batch.column(c).to_pylist() for c in ("digest", "n_bytes", "media")), strict=True):
                payload = decode_png(media)
                samples = np.frombuffer(payload, np.uint8)
                counts = np.bincount(samples, minlength=256)
                share = counts[counts > 0] / len(samples)
                feature = f"rows={len(samples) // UNIT};mean={samples.mean():.4f};entropy={float(-(share * np.log2(share)).sum()) + 0.0:.4f};distinct={len(share)}"
                out.append((d, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    names = ["digest", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = "digest string, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return store.mapInArrow(run, kinds).dropDuplicates(["digest"])


def resolve(sequences: DataFrame, store: DataFrame) -> DataFrame:
    """A row per media reference of sequences (column sequence): its other columns, position, caption, digest, and the store's columns (null if it lacks the digest)."""
    others = [c for c in sequences.columns if c != "sequence"]
    refs = sequences.select(*others, F.explode(F.filter("sequence", lambda s: s["kind"] == "media")).alias("s"))
    return refs.select(*others, "s.position", "s.caption", F.col("s.digest").alias("digest")).join(store, "digest", "left")


#: A document's page shows its payload before the first and every so many further lines.
FIGURE_EVERY = 4


def page_html(text: Column, key: Column) -> Column:
    """A page with a paragraph per line of a text and, among them, numbered figures that refer to the whole text as a payload."""
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    def part(line: Column, i: Column) -> Column:
        number = (F.floor(i / FIGURE_EVERY) + 1).cast("string")
        figure = F.concat(F.lit(f'<figure><img src="{SCHEME}'), F.col("digest"), F.lit('"><figcaption>document '), safe(key), F.lit(" figure "), number, F.lit("</figcaption></figure>"))
        return F.concat(F.when(i % FIGURE_EVERY == 0, figure).otherwise(F.lit("")), F.lit("<p>"), line, F.lit("</p>"))

    return F.concat(F.lit("<html><head><title>document</title></head><body>"), F.array_join(F.transform(F.split(safe(text), "\n"), part), ""), F.lit("</body></html>"))


def resolved_pages(pages: DataFrame, store: DataFrame) -> DataFrame:
    """Pages (row, sequence, others) with found, an array of the store's rows for their media references in order, null for a digest that the
    store lacks.

    Each reference meets the store by its digest, and a page's references come together by its row's number.
    """
    others = [c for c in pages.columns if c not in ("row", "sequence")]
    columns = F.struct(*[c for c in store.columns if c != "digest"], F.lit(True).alias("_there"))
    refs = pages.select("row", F.explode(F.filter("sequence", lambda s: s["kind"] == "media")).alias("s")).select("row", "s.position", "s.digest")
    met = refs.join(store.select("digest", columns.alias("stored")), "digest", "left")
    found = met.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("position", F.when(F.col("stored._there"), F.col("stored")).alias("stored")))).alias("found"))
    return pages.select("row", "sequence", *others).join(found, "row", "left")


def op6_media_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pages of paragraphs and figures; every figure's payload is resolved by digest.

    n_texts, n_media: items of the sequence; positions, captions: of its references; items_sha256: of the whole
    ordered sequence (kind, text or digest, and caption of each item); resolved_sha256: of what was read back for each
    reference in order (its payload's digest). A document's figures share its payload, so the first one's is the row's.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("digest"))
    pages = keyed.select("doc_id", page_html(F.col("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias("html"))
    media = F.filter("sequence", lambda s: s["kind"] == "media")
    item = lambda s: F.concat_ws("\x1f", s["kind"], F.coalesce(s["text"], s["digest"], F.lit("")), F.coalesce(s["caption"], F.lit("")))
    # rows get a number that stays: ids may be null or repeated; texts are told by their digest from here on
    sequences = stored(
        parse_sequences(pages, "doc_id", "html").select(
            F.monotonically_increasing_id().alias("row"), "doc_id", media.alias("sequence"), (F.size("sequence") - F.size(media)).cast("long").alias("n_texts"), F.size(media).cast("long").alias("n_media"),
            F.array_join(F.transform(media, lambda s: s["position"]), ",").alias("positions"), F.array_join(F.transform(media, lambda s: s["caption"]), ",").alias("captions"),
            F.sha2(F.array_join(F.transform("sequence", item), "\x1e"), 256).alias("items_sha256"),
        ), "sequences",
    )
    found = resolved_pages(sequences, read_store(stored(media_rows(docs), "media")))
    own = F.get("found", F.lit(0))["stored"]
    back = F.sha2(F.array_join(F.transform("found", lambda x: F.coalesce(x["stored"]["payload_sha256"], F.lit("-"))), ","), 256)
    payload = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    return found.select("doc_id", *[own[c].alias(c) for c in payload], "n_texts", "n_media", "positions", "captions", "items_sha256", back.alias("resolved_sha256"))


def page_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All web pages as sequences: their texts and references in order, counted and digested."""
    media = F.filter("sequence", lambda s: s["kind"] == "media")
    texts = F.transform(F.filter("sequence", lambda s: s["kind"] == "text"), lambda s: s["text"])
    return parse_sequences(table(spark, sf_dir, "pages"), "page_id", "html").select(
        "page_id", (F.size("sequence") - F.size(media)).cast("long").alias("n_texts"), F.size(media).cast("long").alias("n_media"), F.sha2(F.array_join(texts, "\n"), 256).alias("texts_sha256"), F.length(F.array_join(texts, "")).cast("long").alias("text_chars"),
    )
