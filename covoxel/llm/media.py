"""Interleaved documents: ordered text and media references from HTML, resolved by digest."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A media reference in HTML: the address of an element is this and the digest of the stored bytes.
SCHEME = "sha256:"
WIDTH = 64
ITEMS = "array<struct<position: int, kind: string, text: string, digest: string, caption: string>>"
_MEDIA = {"img", "audio", "video", "source", "embed"}
_UNSEEN = {"script", "style", "template", "noscript", "head"}
_BLOCKS = {"p", "div", "figure", "figcaption", "li", "ul", "ol", "table", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "br", "body", "html", "blockquote", "pre"}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.text: list[str] = []
        self.caption: list[str] | None = None
        self.figure: list[int] = []
        self.unseen: list[str] = []

    def flush(self) -> None:
        said = " ".join("".join(self.text).split())
        self.text = []
        if said:
            self.items.append({"position": len(self.items), "kind": "text", "text": said, "digest": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _UNSEEN:
            self.unseen.append(tag)
        if self.unseen:
            return
        if tag in _BLOCKS:
            self.flush()
        if tag == "figure":
            self.figure = []
        if tag == "figcaption":
            self.caption = []
        at = dict(attrs)
        if tag in _MEDIA and at.get("src"):
            self.flush()
            src = at["src"]
            digest = src.removeprefix(SCHEME).lower() if src.startswith(SCHEME) else None
            self.figure.append(len(self.items))
            self.items.append({"position": len(self.items), "kind": "media", "text": at.get("alt") or None, "digest": digest, "caption": None})

    def handle_endtag(self, tag: str) -> None:
        if self.unseen:
            if tag == self.unseen[-1]:
                self.unseen.pop()
            return
        if tag == "figcaption" and self.caption is not None:
            said = " ".join("".join(self.caption).split())
            for i in self.figure:
                self.items[i]["caption"] = said
            self.caption = None
        if tag in _BLOCKS:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            (self.text if self.caption is None else self.caption).append(data)


def parse_items(html: str | None) -> list[dict]:
    """The ordered items of a page: text blocks, and media references with digest, alt text and the caption
    of their figure. Null or empty: no items. An address that is no digest gives a null digest."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.items


def sequences(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with `items` in place of html: one row per page, items by position."""
    keep = [c for c in pages.columns if c not in (html, "items")]
    kinds = dict(pages.dtypes)
    kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = pa.array([parse_items(x) for x in b.column(html).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), items], names=[*keep, "items"])

    return pages.select(*keep, html).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", items {ITEMS}")


def interleave(pages: DataFrame, media: DataFrame, html: str = "html") -> DataFrame:
    """One row per item of every page: pages' columns, position, kind, text, caption, digest, and media's
    columns as the struct `media`, found by digest (null: text, or unknown digest).

    media has a column digest and any others; rows that repeat a digest count once. The references of
    a page are joined on digest only, in a plain equi-join whose hot keys AQE splits; positions and
    captions travel with the reference, so they stay aligned whatever the join's order. Pages without
    items give no rows. Null digests join nothing. Of rows of media with one digest any counts, since equal digests mean
    equal bytes. Columns of pages that have the name of an added one are replaced. A very long page is one row's items.
    """
    refs = sequences(pages, html)
    keep = [c for c in refs.columns if c != "items"]
    one = refs.select(*keep, F.explode("items").alias("__item"))
    # Written first: AQE splits the join of a hot digest only if no aggregate feeds it.
    known = stored(media.where("digest is not null").dropDuplicates(["digest"]), "media").select(F.col("digest").alias("__found"), F.struct(*[c for c in media.columns if c != "digest"]).alias("media"))
    out = one.join(known, F.col("__item.digest") == F.col("__found"), "left")
    clash = {"position", "kind", "text", "caption", "digest", "media"}
    return out.select(*[f"`{c}`" for c in keep if c not in clash], *[f"__item.{c}" for c in ("position", "kind", "text", "caption", "digest")], "media")


def to_png(payload: bytes, width: int = WIDTH) -> bytes:
    """A grey image of 8-bit samples, row by row; len(payload) is a positive multiple of width."""
    rows = np.zeros((len(payload) // width, width + 1), dtype=np.uint8)
    rows[:, 1:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, width)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows.tobytes(), 4)) + part(b"IEND", b"")


def from_png(png: bytes) -> np.ndarray:
    """The samples of an image that to_png() wrote; its checksums are verified."""
    if png[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, parts = 8, {b"IDAT": b""}
    while at < len(png):
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        data = png[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("a PNG chunk is damaged")
        parts[kind] = parts.get(kind, b"") + data
        at += 12 + n
    width, height = struct.unpack(">II", parts[b"IHDR"][:8])
    rows = np.frombuffer(zlib.decompress(parts[b"IDAT"]), dtype=np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("rows with filters aren't written here")
    return rows[:, 1:]


def image_feature(samples: np.ndarray) -> str:
    """Size, mean and spread of the samples, and a 64-bit difference hash of 8 x 9 cell means."""
    x = samples.astype(np.float64)
    h, w = x.shape
    ys, xs = np.linspace(0, h, 9).astype(int), np.linspace(0, w, 10).astype(int)
    rows = np.add.reduceat(x, np.minimum(ys[:-1], h - 1), axis=0)
    cells = np.add.reduceat(rows, xs[:-1], axis=1)
    bits = np.packbits(cells[:, 1:] > cells[:, :-1]).tobytes().hex()
    return f"{w}x{h};mean={x.mean():.4f};sd={x.std():.4f};dhash={bits}"


MEDIA = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"


def media_facts(media: DataFrame) -> DataFrame:
    """From (digest, stored): what the stored bytes hold, read back from them. Null stored bytes are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for digest, png in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if hashlib.sha256(png).hexdigest() != digest:
                    raise ValueError(f"stored bytes differ from their digest {digest}")
                x = from_png(png)
                payload = x.tobytes()
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), image_feature(x)))
            names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "feature"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return media.select("digest", "stored").where("stored is not null").mapInArrow(run, MEDIA)


def text_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, html, digest, stored): each text as the samples of an image, and a page that shows it.

    Null texts are empty; a payload is padded with bytes 0 to a positive multiple of WIDTH. Within a
    batch, equal texts store their image once and the others leave `stored` null.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: dict[str, str] = {}
            rows: list[tuple] = []
            for text in b.column("text").to_pylist():
                raw = (text or "").encode("utf-8", "replace")
                first = raw not in made
                png = None
                if first:
                    png = to_png(raw + b"\0" * (-len(raw) % WIDTH if raw else WIDTH))
                    made[raw] = hashlib.sha256(png).hexdigest()
                digest = made[raw]
                rows.append((len(raw), f'<figure><img src="{SCHEME}{digest}"><figcaption>{escape(f"{len(raw)} bytes")}</figcaption></figure>', digest, png))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", "n_bytes", "html", "digest", "stored"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, html string, digest string, stored binary")


def media_columns(docs: DataFrame) -> DataFrame:
    """Every text stored as an image, referred to from a page, and resolved again: one row per document.

    The images are written once to the shared folder and read back from it; they are never shuffled:
    facts are computed where the image is read, and those few columns are joined to the references by
    digest. Repeated texts share a digest; a null text is an empty one; no rows give no rows.
    """
    made = stored(text_media(docs), "media")
    facts = media_facts(made.select("digest", "stored"))
    shown = interleave(made.select("doc_id", "n_bytes", "html"), facts)
    return shown.where("kind = 'media'").select("doc_id", "n_bytes", "media.payload_bytes", "media.payload_sha256", "media.tail_crc32", "media.media_bytes", F.col("digest").alias("media_sha256"), "media.feature", "position", "caption")
