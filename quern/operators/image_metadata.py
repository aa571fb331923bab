"""What image files hold beside their pixels: tags, comments, texts and profiles.

Only heads are read: the chunks of a PNG, the segments of a JPEG up to its pixels, and the directories
of a TIFF. Lengths that a file claims are held against its size, directories are visited once, and a
file gives ``MOST`` directories at most, so a broken or hostile file costs no more than its own bytes.
A file of another kind, or one that breaks off, is reported as unreadable. An empty or null file is
unreadable too.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Directories of a file that are looked into.
MOST = 64
#: Tags that say how pixels are stored, and those that lead to other directories (fixed values).
PIXEL_TAGS = {254, 256, 257, 258, 259, 262, 273, 277, 278, 279, 282, 283, 284, 296, 317, 320, 322, 323, 324, 325, 338, 339}
POINTERS = {34665: "exif", 34853: "gps", 40965: "interoperability"}
#: PNG chunks that say something beside pixels; texts give their keyword instead (fixed values).
PNG_KEYS = {b"iCCP": "icc_profile", b"gAMA": "gamma", b"tIME": "time", b"sRGB": "srgb", b"cHRM": "chromaticity"}
PNG_TEXTS = (b"tEXt", b"zTXt", b"iTXt")


class Unreadable(ValueError):
    """A file that isn't what it says."""


def _take(data: bytes, form: str, at: int) -> tuple:
    if at < 0 or at + struct.calcsize(form) > len(data):
        raise Unreadable("the file breaks off")
    return struct.unpack_from(form, data, at)


def tiff_tags(data: bytes, file: bool = False) -> list[str]:
    """Tags of all directories, as ``tag:number`` (``gps:number`` for places). ``file``: of a picture,
    whose tags about storage don't count."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or _take(data, order + "H", 2) != (42,):
        raise Unreadable("no TIFF head")
    found, seen, waiting = [], set(), [(_take(data, order + "I", 4)[0], "tag")]
    while waiting and len(seen) < MOST:
        at, kind = waiting.pop(0)
        if not at or at in seen:
            continue
        seen.add(at)
        (n,) = _take(data, order + "H", at)
        for k in range(n):
            tag, _, _, value = _take(data, order + "HHII", at + 2 + 12 * k)
            if tag in POINTERS:
                waiting.append((value, "gps" if POINTERS[tag] == "gps" else kind))
            elif not (file and tag in PIXEL_TAGS):
                found.append(f"{kind}:{tag}")
        waiting.append((_take(data, order + "I", at + 2 + 12 * n)[0], kind))
    return found


def png_keys(data: bytes) -> list[tuple[str, str]]:
    """(issue, key) of a PNG's chunks."""
    at, found = 8, []
    while True:
        length, name = _take(data, ">I4s", at)
        if at + 12 + length > len(data):
            raise Unreadable("a chunk breaks off")
        body = data[at + 8 : at + 8 + length] if name in (*PNG_TEXTS, b"eXIf") else b""
        if name == b"eXIf":
            found += [("exif-present", t) for t in tiff_tags(body)]
        elif name in PNG_TEXTS:
            found.append(("metadata-present", body.split(b"\0", 1)[0].decode("latin-1")))
        elif name in PNG_KEYS:
            found.append(("metadata-present", PNG_KEYS[name]))
        elif name == b"IEND":
            return found
        at += 12 + length


def jpeg_keys(data: bytes) -> list[tuple[str, str]]:
    """(issue, key) of a JPEG's segments before its pixels."""
    at, found = 2, []
    while True:
        mark, kind = _take(data, ">BB", at)
        if mark != 0xFF:
            raise Unreadable("no segment where one should be")
        if kind == 0xFF:
            at += 1
            continue
        if kind in (0xDA, 0xD9):
            return found
        if kind == 0x01 or 0xD0 <= kind <= 0xD7:
            at += 2
            continue
        (length,) = _take(data, ">H", at + 2)
        body = data[at + 4 : at + 2 + length]
        if length < 2 or len(body) != length - 2:
            raise Unreadable("a segment breaks off")
        if kind == 0xFE:
            found.append(("metadata-present", "comment"))
        elif kind == 0xE1 and body.startswith(b"Exif\0\0"):
            found += [("exif-present", t) for t in tiff_tags(body[6:])]
        elif kind == 0xE1:
            found.append(("metadata-present", "xmp" if body.startswith(b"http://ns.adobe.com/xap/") else "app1"))
        elif kind == 0xE2 and body.startswith(b"ICC_PROFILE\0"):
            found.append(("metadata-present", "icc_profile"))
        elif 0xE2 <= kind <= 0xEF:
            found.append(("metadata-present", f"app{kind - 0xE0}"))
        at += 2 + length


def keys(data: bytes | None) -> list[tuple[str, str]]:
    """(issue, key), each once, of one file."""
    data = data or b""
    try:
        if data.startswith(b"\x89PNG\r\n\x1a\n"):
            found = png_keys(data)
        elif data.startswith(b"\xff\xd8"):
            found = jpeg_keys(data)
        elif data[:2] in (b"II", b"MM"):
            found = [("exif-present", t) for t in tiff_tags(data, file=True)]
        else:
            raise Unreadable("unknown kind")
    except Unreadable as broken:
        return [("unreadable", str(broken))]
    return list(dict.fromkeys(found))


def scan(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(``path``, ``issue``, ``key``) of everything found in files given as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, *pair) for name, data in zip(batch.column(0).to_pylist(), batch.column(1)) for pair in keys(data.as_py())]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["path", "issue", "key"])

    return files.select(F.col(path).cast("string").alias("path"), content).mapInArrow(run, "path string, issue string, key string")


def scan_folder(spark: SparkSession, path: str, glob: str = "*.{png,jpg,jpeg,tif,tiff}") -> DataFrame:
    """``scan`` of all images below a folder."""
    return scan(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path))
