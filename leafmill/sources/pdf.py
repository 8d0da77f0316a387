"""Pages of PDF files.

A reader for the text layer: plain or deflated contents, objects in object
streams, resources that pages inherit, fonts of one or two bytes a sign with
their maps to Unicode. It draws nothing. Encrypted files are unreadable. Any
other reader is a function of the same form; recognition plugs in likewise.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import orientation_of

#: (page number, text, rotation, error) of each page, and perhaps its image; an error in one page is its own.
Reader = Callable[[bytes], Iterator[tuple]]

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_NUMBER = rb"[-+]?(?:\d+\.?\d*|\.\d+)"
_SHOW = re.compile(
    rb"(?P<string>\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>)|/(?P<font>[^\s/\[\]()<>]+)\s+" + _NUMBER + rb"\s+Tf\b|(?P<dx>" + _NUMBER + rb")\s+(?P<dy>" + _NUMBER + rb")\s+T[dD](?![A-Za-z])"
    rb"|(?:" + _NUMBER + rb"\s+){5}(?P<y>" + _NUMBER + rb")\s+Tm(?![A-Za-z])|(?P<op>(?:T\*|T[jJ]|'|\"|BT|ET)(?![A-Za-z]))|(?P<array>[\[\]])|(?P<number>" + _NUMBER + rb")",
    re.S,
)
_ESCAPE = re.compile(rb"\\([nrtbf()\\]|[0-7]{1,3}|\r?\n)")
#: A gap between the strings of an array from which on they are words of their own, in thousandths of the font's size.
WORD_GAP = 180


class UnreadablePDF(ValueError):
    """The file can't be opened, or has no page."""


class Font:
    """How a font's strings are read: bytes of a sign, and its signs in Unicode."""

    def __init__(self, body: bytes = b"", cmap: bytes = b""):
        self.width = 2 if b"/Type0" in body else 1
        self.signs: dict[int, str] = {}
        if space := re.search(rb"begincodespacerange\s*<([0-9A-Fa-f]+)>", cmap):
            self.width = max(1, len(space[1]) // 2)
        text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            for code, to in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]*)>", block):
                self.signs[int(code, 16)] = text(to)
        for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
            for low, high, to, each in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f]*)>|\[(.*?)\])", block, re.S):
                start, stop = int(low, 16), min(int(high, 16), int(low, 16) + 0xFFFF)
                if to:
                    last = text(to)
                    self.signs |= {start + k: last[:-1] + chr(min(ord(last[-1]) + k, 0x10FFFF)) for k in range(stop - start + 1)}
                else:
                    self.signs |= {start + k: text(x) for k, x in enumerate(re.findall(rb"<([0-9A-Fa-f]*)>", each))}

    def read(self, data: bytes) -> str:
        if not self.signs:
            return data[2:].decode("utf-16-be", "replace") if data[:2] == b"\xfe\xff" else data.decode("cp1252", "replace")
        codes = [int.from_bytes(data[i : i + self.width], "big") for i in range(0, len(data), self.width)]
        return "".join(self.signs.get(c) or (bytes([c]).decode("cp1252", "replace") if self.width == 1 else "\ufffd") for c in codes)


def _string(token: bytes) -> bytes:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    plain = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
    return _ESCAPE.sub(lambda m: plain.get(m[1], b"" if m[1][-1:] == b"\n" else bytes([int(m[1], 8) & 255]) if m[1].isdigit() else m[1]), token[1:-1])


def content_text(content: bytes, fonts: dict[bytes, Font] | None = None) -> str:
    """The strings that a content stream shows. Moves to another height end lines; moves along a line, and wide gaps, part words."""
    out: list[str] = []
    pending: list[str] = []
    font, height, within = Font(), None, False

    def part(sign: str) -> None:
        if out and not out[-1].endswith(("\n", sign)):
            out.append(sign)

    for m in _SHOW.finditer(content):
        if m["string"] is not None:
            pending.append(font.read(_string(m["string"])))
        elif m["font"] is not None:
            font = (fonts or {}).get(m["font"], Font())
        elif m["array"] is not None:
            within = m["array"] == b"["
        elif m["number"] is not None:
            if within and pending and float(m["number"]) < -WORD_GAP and not pending[-1].endswith(" "):
                pending.append(" ")
        elif m["dy"] is not None:
            part("\n" if float(m["dy"]) else " ")
            pending = []
        elif m["y"] is not None:
            part(" " if height == float(m["y"]) else "\n")
            height, pending = float(m["y"]), []
        elif m["op"] in (b"Tj", b"TJ"):
            out += pending
            pending = []
        elif m["op"] == b"BT":
            pending = []
        else:
            part("\n")
            out += pending if m["op"] in (b"'", b'"') else []
            pending = []
    return "".join(out).strip()


def _content(stream: bytes) -> bytes:
    """The bytes of an object's stream, unpacked; nothing if it has none."""
    m = _STREAM.search(stream)
    if not m:
        return b""
    return zlib.decompressobj().decompress(m[1]) if b"/FlateDecode" in stream[: m.start()] else m[1]


def _objects(data: bytes) -> dict[int, bytes]:
    """All objects by number, those in object streams too; of one number the last in the file."""
    out = {int(m[1]): m[2] for m in _OBJECT.finditer(data)}
    for body in [x for x in out.values() if b"/ObjStm" in x]:
        first = re.search(rb"/First\s+(\d+)", body)
        try:
            plain = _content(body)
        except zlib.error:
            continue  # what is in it is missing
        start = int(first[1]) if first else 0
        head = list(map(int, re.findall(rb"\d+", plain[:start])))
        numbers, offsets = head[0::2], head[1::2]
        for k, (number, at) in enumerate(zip(numbers, offsets, strict=False)):
            out.setdefault(number, plain[start + at : start + offsets[k + 1] if k + 1 < len(offsets) else None])
    return out


def _entry(name: bytes, body: bytes, objects: dict[int, bytes]) -> bytes:
    """The dictionary of a name in ``body``, whether it stands there or is referred to."""
    if m := re.search(rb"/" + name + rb"\s+(\d+)\s+\d+\s+R", body):
        return objects.get(int(m[1]), b"")
    m = re.search(rb"/" + name + rb"\s*<<", body)
    if not m:
        return b""
    depth, at = 1, m.end()
    while depth and (n := re.search(rb"<<|>>", body[at:])):
        depth += 1 if n[0] == b"<<" else -1
        at += n.end()
    return body[m.end() : at]


def _resources(k: int, objects: dict[int, bytes]) -> bytes:
    """A page's resources, its own or those of the nodes above it."""
    seen: set[int] = set()
    while k in objects and k not in seen:
        seen.add(k)
        if found := _entry(b"Resources", objects[k], objects):
            return found
        parent = re.search(rb"/Parent\s+(\d+)", objects[k])
        k = int(parent[1]) if parent else -1
    return b""


def _fonts(resources: bytes, objects: dict[int, bytes], known: dict[int, Font]) -> dict[bytes, Font]:
    out = {}
    for name, ref in re.findall(rb"/([^\s/\[\]()<>]+)\s+(\d+)\s+\d+\s+R", _entry(b"Font", resources, objects)):
        n = int(ref)
        if n not in known:
            body = objects.get(n, b"")
            to = re.search(rb"/ToUnicode\s+(\d+)", body)
            try:
                known[n] = Font(body, _content(objects.get(int(to[1]), b"")) if to else b"")
            except (ValueError, zlib.error):
                known[n] = Font(body)
        out[name] = known[n]
    return out


def _image(resources: bytes, objects: dict[int, bytes]) -> bytes | None:
    """The largest JPEG image that a page shows: of a scanned page, the scan."""
    found = []
    for ref in _REF.findall(_entry(b"XObject", resources, objects)):
        stream = objects.get(int(ref), b"")
        m = _STREAM.search(stream)
        if m and b"/DCTDecode" in stream[: m.start()]:
            found.append(m[1])
    return max(found, key=len, default=None)


def read_pages(data: bytes) -> Iterator[tuple[int, str | None, int, str | None, bytes | None]]:
    """Pages in the order of the page tree, with the images of scanned ones."""
    if not data.startswith(b"%PDF"):
        raise UnreadablePDF("no PDF")
    if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
        raise UnreadablePDF("encrypted")
    objects = _objects(data)
    root = next((k for k, v in objects.items() if re.search(rb"/Type\s*/Pages\b", v) and b"/Parent" not in v), None)

    def leaves(k: int, seen: frozenset = frozenset()) -> Iterator[int]:
        body = objects.get(k, b"")
        if re.search(rb"/Type\s*/Page\b(?!s)", body):
            yield k
        elif k not in seen and (kids := re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)):
            for kid in _REF.findall(kids[1]):
                yield from leaves(int(kid), seen | {k})

    pages = list(leaves(root)) if root is not None else []
    if not pages:
        raise UnreadablePDF("no page")
    known: dict[int, Font] = {}
    for number, k in enumerate(pages, 1):
        try:
            body = objects[k]
            rotation = int(m[1]) if (m := re.search(rb"/Rotate\s+(-?\d+)", body)) else 0
            refs = re.search(rb"/Contents\s*(?:\[(.*?)\]|(\d+\s+\d+\s+R))", body, re.S)
            content = b"\n".join(_content(objects.get(int(ref), b"")) for ref in _REF.findall((refs[1] or refs[2]) if refs else b""))
            resources = _resources(k, objects)
            yield number, content_text(content, _fonts(resources, objects, known)) or None, rotation, None, _image(resources, objects)
        except (ValueError, zlib.error, TypeError) as e:
            yield number, None, 0, f"{type(e).__name__}: {e}"[:200], None


def pages_of(files: DataFrame, reader: Reader = read_pages) -> DataFrame:
    """(sha256, file_name, page_id, page_number, text_layer_text, image, orientation, error) of each page of each file.

    A page id is the file name and the number, from 1. A file that can't be
    read, or has no page, is one row with page_number 0 and the error. The
    image is null where the reader gives none.
    """

    def run(frames):
        for f in frames:
            rows = []
            for sha, name, content in zip(f["sha256"], f["file_name"], f["content"], strict=True):
                try:
                    rows += [(sha, name, f"{name}-{n}", n, text, rotation, error, image[0] if image else None) for n, text, rotation, error, *image in reader(bytes(content or b""))]
                except Exception as e:  # noqa: BLE001  (a file's fault must not end the task)
                    rows.append((sha, name, None, 0, None, 0, f"{type(e).__name__}: {e}"[:200], None))
            yield pd.DataFrame(rows, columns=["sha256", "file_name", "page_id", "page_number", "text_layer_text", "rotation", "error", "image"])

    pages = files.select("sha256", "file_name", "content").mapInPandas(run, "sha256 string, file_name string, page_id string, page_number int, text_layer_text string, rotation int, error string, image binary")
    return pages.withColumn("orientation", orientation_of("rotation").cast("int")).drop("rotation")


def recognise(pages: DataFrame, recogniser: Callable[[bytes, int, int, list[str]], tuple[list[str], list[float]]], tries: list[tuple[int, int]]) -> DataFrame:
    """Candidates (page_id, orientation, dpi, text, confidence) of page images (page_id, image, languages) for each (orientation, dpi).

    Lines are joined by line feeds; the confidence is the mean of the lines', 0
    without any. A recogniser's error gives an empty candidate, and so does a
    page without an image.
    """
    signals = F.array(*[F.struct(F.lit(o).alias("orientation"), F.lit(d).alias("dpi")) for o, d in tries])
    asked = pages.select("page_id", "image", "languages", F.explode(signals).alias("s")).select("page_id", "image", "languages", "s.*")

    def run(frames):
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                try:
                    lines, confidences = recogniser(bytes(r.image), r.orientation, r.dpi, list(r.languages))
                except Exception:  # noqa: BLE001
                    lines, confidences = [], []
                rows.append((r.page_id, r.orientation, r.dpi, "\n".join(lines), sum(confidences) / len(confidences) if confidences else 0.0))
            yield pd.DataFrame(rows, columns=["page_id", "orientation", "dpi", "text", "confidence"])

    return asked.mapInPandas(run, "page_id string, orientation int, dpi int, text string, confidence double")


def resampled_size(width: Column | str, height: Column | str, dpi: int, reference: int) -> tuple:
    """Width and height of an image at another resolution, at least 72 dots an inch and one pixel; the same resolution changes nothing."""
    scale = max(72, dpi) / max(72, reference)
    size = lambda c: F.greatest(F.lit(1), F.round(F.col(c) * scale if isinstance(c, str) else c * scale).cast("int"))
    return (F.col(width), F.col(height)) if dpi == reference else (size(width), size(height))
