"""PDFs of scans: each page is one image. Those are read and written here in plain Python; a renderer for others may be given."""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.DOTALL)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.DOTALL)


def page_images(content: bytes) -> list[tuple[str, int, int, int, bytes]]:
    """(encoding, width, height, channels, data) of each page in order: 'jpeg' data as stored, 'raw' data unpacked."""
    if not content.startswith(b"%PDF-"):
        raise ValueError("not a PDF")
    objects = {int(n): body for n, _, body in _OBJECT.findall(content)}
    out = []
    for kid in _kids(objects):
        out.append(_image(objects.get(kid, b""), objects))
    if not out:
        raise RuntimeError("PDF has 0 pages")
    return out


def _image(page: bytes, objects) -> tuple[str, int, int, int, bytes]:
    """The one image of a page."""
    for ref in map(int, re.findall(rb"/\w+\s+(\d+)\s+0\s+R", _resources(page, objects))):
        body = objects.get(ref, b"")
        head = body.partition(b"stream")[0]
        if b"/Image" not in head:
            continue
        if length := re.search(rb"/Length\s+(\d+)(?!\s+\d+\s+R)", head):  # data may hold anything, endstream too
            at = len(head) + len(b"stream") + (2 if body[len(head) + 6 :].startswith(b"\r\n") else 1)
            data = body[at : at + int(length[1])]
        elif m := _STREAM.search(body):
            data = m[1]
        else:
            continue
        width, height = (int(re.search(rb"/%s\s+(\d+)" % k, head)[1]) for k in (b"Width", b"Height"))
        channels = 1 if b"/DeviceGray" in head else 3
        return ("jpeg", width, height, channels, data) if b"/DCTDecode" in head else ("raw", width, height, channels, zlib.decompress(data) if b"/FlateDecode" in head else data)
    raise ValueError("a page that isn't one image; give a renderer")


def _kids(objects: dict[int, bytes]) -> list[int]:
    roots = [b for b in objects.values() if re.search(rb"/Type\s*/Pages\b", b) and b"/Parent" not in b]

    def below(body: bytes) -> Iterator[int]:
        kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.DOTALL)
        for k in map(int, re.findall(rb"(\d+)\s+\d+\s+R", kids[1] if kids else b"")):
            if re.search(rb"/Type\s*/Pages\b", objects.get(k, b"")):
                yield from below(objects[k])
            else:
                yield k

    return [k for r in roots for k in below(r)]


def _resources(page: bytes, objects: dict[int, bytes]) -> bytes:
    if m := re.search(rb"/Resources\s+(\d+)\s+\d+\s+R", page):
        page = objects.get(int(m[1]), b"")
    if m := re.search(rb"/XObject\s+(\d+)\s+\d+\s+R", page):
        page = objects.get(int(m[1]), b"")
    elif m := re.search(rb"/XObject\s*<<(.*?)>>", page, re.DOTALL):
        page = m[1]
    return page


class Stream:
    """Writes a PDF page by page as pages come; what is kept of each is where its objects are."""

    def __init__(self, out, dpi: int = 300):
        self.out, self.dpi, self.at, self.offsets = out, dpi, 0, {}
        self.pages = 0
        self._put(b"%PDF-1.4\n")

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _object(self, number: int, *body: bytes) -> None:
        self.offsets[number] = self.at
        self._put(b"%d 0 obj\n%s\nendobj\n" % (number, b"".join(body)))

    def add(self, encoding: str, width: int, height: int, channels: int, data: bytes) -> None:
        """A page of one image: 'raw' data is packed without loss, 'jpeg' data stays as it is."""
        first = 3 + 3 * self.pages
        self.pages += 1
        pw, ph = width * 72 / self.dpi, height * 72 / self.dpi
        draw = f"q {pw:.4f} 0 0 {ph:.4f} 0 0 cm /Im Do Q".encode()
        packed = data if encoding == "jpeg" else zlib.compress(data)
        self._object(first, f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {pw:.4f} {ph:.4f}] /Contents {first + 1} 0 R /Resources << /XObject << /Im {first + 2} 0 R >> >> >>".encode())
        self._object(first + 1, b"<< /Length %d >>\nstream\n" % len(draw), draw, b"\nendstream")
        kind, space = b"DCTDecode" if encoding == "jpeg" else b"FlateDecode", b"DeviceGray" if channels == 1 else b"DeviceRGB"
        self._object(first + 2, b"<< /Type /XObject /Subtype /Image /Width %d /Height %d /ColorSpace /%s /BitsPerComponent 8 /Filter /%s /Length %d >>\nstream\n" % (width, height, space, kind, len(packed)), packed, b"\nendstream")

    def close(self) -> None:
        self._object(1, b"<< /Type /Catalog /Pages 2 0 R >>")
        self._object(2, b"<< /Type /Pages /Count %d /Kids [%s] >>" % (self.pages, b" ".join(b"%d 0 R" % (3 + 3 * k) for k in range(self.pages))))
        at, n = self.at, len(self.offsets) + 1
        self._put(b"xref\n0 %d\n0000000000 65535 f \n" % n + b"".join(b"%010d 00000 n \n" % self.offsets[k] for k in range(1, n)))
        self._put(b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (n, at))


def written(pages: list[tuple[int, int, int, bytes]], dpi: int = 300) -> bytes:
    """A PDF of (width, height, channels, raw data) pages, packed without loss."""
    out = io.BytesIO()
    stream = Stream(out, dpi)
    for page in pages:
        stream.add("raw", *page)
    stream.close()
    return out.getvalue()


class Index:
    """The pages of an open PDF by its table of offsets, so that a page is read without the others."""

    def __init__(self, file, size: int):
        self.file = file
        tail = self._read(max(0, size - 1024), size)
        m = re.search(rb"startxref\s+(\d+)\s+%%EOF\s*$", tail)
        at = int(m[1]) if m else size
        table = self._read(at, size)
        if not table.startswith(b"xref"):
            raise ValueError("no table of offsets")
        self.offsets: dict[int, int] = {}
        rest = table[4 : table.index(b"trailer")].split()
        while rest:
            first, n = int(rest[0]), int(rest[1])
            for k in range(n):
                where, _, kind = rest[2 + 3 * k : 5 + 3 * k]
                if kind == b"n":
                    self.offsets[first + k] = int(where)
            rest = rest[2 + 3 * n :]
        ends = sorted({*self.offsets.values(), at})
        self.ends = dict(zip(ends, ends[1:], strict=False))
        root = self[int(re.search(rb"/Root\s+(\d+)", table)[1])]
        self.kids = self._below(int(re.search(rb"/Pages\s+(\d+)", root)[1]))

    def _read(self, begin: int, end: int) -> bytes:
        self.file.seek(begin)
        return self.file.read(end - begin)

    def __getitem__(self, number: int) -> bytes:
        """The body of an object; an unknown one is empty."""
        if number not in self.offsets:
            return b""
        at = self.offsets[number]
        return self._read(at, self.ends[at])

    def get(self, number: int, default: bytes = b"") -> bytes:
        return self[number] or default

    def _below(self, number: int) -> list[int]:
        body = self[number]
        if not re.search(rb"/Type\s*/Pages\b", body):
            return [number]
        kids = re.search(rb"/Kids\s*\[(.*?)\]", body, re.DOTALL)
        return [x for k in re.findall(rb"(\d+)\s+\d+\s+R", kids[1] if kids else b"") for x in self._below(int(k))]

    def page(self, k: int) -> tuple[str, int, int, int, bytes]:
        return _image(self.get(self.kids[k]), self)


def split(files: DataFrame, render: Callable[[bytes], list[tuple[str, int, int, int, bytes]]] = page_images) -> DataFrame:
    """path, page_no (from 1), encoding, width, height, channels, data, error: a row a page, or one with the error of a file that can't be read.

    ``files`` has path and content; ``render`` turns a file's bytes into its pages, as ``page_images`` does.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "page_no", "encoding", "width", "height", "channels", "data", "error"]
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows = [(path, k, *page, None) for k, page in enumerate(render(bytes(content)), 1)]
                except Exception as e:
                    rows = [(path, None, None, None, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=names).astype({"page_no": "Int32", "width": "Int32", "height": "Int32", "channels": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, page_no int, encoding string, width int, height int, channels int, data binary, error string")
