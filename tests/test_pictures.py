"""Image heads, pixel moments and resampling against brute force."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quern.operators import image_metadata as im, pixels
from quern.plans import bindings


def chunk(name, body):
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))


def png(*extra):
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + b"".join(chunk(*e) for e in extra) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def segment(kind, body):
    return struct.pack(">BBH", 0xFF, kind, len(body) + 2) + body


def jpeg(*extra):
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0") + b"".join(segment(*e) for e in extra) + segment(0xDA, b"\1") + b"\xff\xfe\xff\xe1pixels"


def test_marks_of_each_kind(spark, tmp_path):
    files = {
        "plain.png": png((b"pHYs", bytes(9))),
        "text.png": png((b"tEXt", b"Author\0A"), (b"zTXt", b"Comment\0\0x"), (b"iTXt", b"Title\0\0\0\0\0x"), (b"tIME", bytes(7)), (b"iCCP", b"p\0\0")),
        "exif.png": png((b"eXIf", bindings.exif(271, True))),
        "plain.jpg": jpeg(),
        "marks.jpg": jpeg((0xFE, b"c"), (0xE1, b"http://ns.adobe.com/xap/1.0/\0x"), (0xE2, b"ICC_PROFILE\0"), (0xED, b"Photoshop"), (0xE1, b"Exif\0\0" + bindings.exif(306))),
        "a.tif": bindings.exif(315),
        "storage.tif": bindings.exif(256),
        "other.png": b"GIF89a",
        "cut.jpg": jpeg((0xFE, b"comment"))[:17],
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {}
    for r in im.scan_folder(spark, str(tmp_path)).collect():
        got.setdefault(r.path.rpartition("/")[2], []).append((r.issue, r.key))
    some = lambda *keys: [("metadata-present", k) for k in keys]
    assert got == {
        "text.png": some("Author", "Comment", "Title", "time", "icc_profile"),
        "exif.png": [("exif-present", "tag:271"), ("exif-present", "gps:2")],
        "marks.jpg": [*some("comment", "xmp", "icc_profile", "app13"), ("exif-present", "tag:306")],
        "a.tif": [("exif-present", "tag:315")],
        "other.png": [("unreadable", "unknown kind")],
        "cut.jpg": [("unreadable", "a segment breaks off")],
    }


def test_files_without_bytes(spark):
    assert im.scan(spark.createDataFrame([("a", None), ("b", b""), ("c", png())], "path string, content binary")).orderBy("path").collect() == [("a", "unreadable", "unknown kind"), ("b", "unreadable", "unknown kind")]
    assert im.scan(spark.createDataFrame([], "path string, content binary")).collect() == []


def test_hostile_directories_end():
    loop = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + struct.pack("<HHII", 34665, 4, 1, 8) + struct.pack("<I", 8)
    assert im.tiff_tags(loop) == []
    with pytest.raises(im.Unreadable):
        im.tiff_tags(b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 60000))
    big = b"MM\0*" + struct.pack(">I", 8) + struct.pack(">H", 1) + struct.pack(">HHII", 271, 2, 4, 0) + struct.pack(">I", 0)
    assert im.tiff_tags(big) == ["tag:271"]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([png((b"tEXt", b"a\0b"), (b"eXIf", bindings.exif(271, True))), jpeg((0xFE, b"c"), (0xE1, b"Exif\0\0" + bindings.exif(306, True))), bindings.exif(1, True)]), st.data())
def test_any_bytes_give_findings(whole, data):
    broken = bytearray(whole[: data.draw(st.integers(0, len(whole)))])
    for _ in range(data.draw(st.integers(0, 4))):
        if broken:
            broken[data.draw(st.integers(0, len(broken) - 1))] = data.draw(st.integers(0, 255))
    assert all(issue in ("unreadable", "exif-present", "metadata-present") for issue, _ in im.keys(bytes(broken)))
    assert im.keys(None) == [("unreadable", "unknown kind")]


@pytest.mark.parametrize("fan_in", [4096, 3])
def test_moments_merge(spark, monkeypatch, fan_in):
    monkeypatch.setattr(pixels, "FAN_IN", fan_in)
    rng = np.random.default_rng(2)
    rows = [rng.normal(1e6, 0.5, rng.integers(1, 30)).tolist() for _ in range(100)]
    odd = [(r,) for r in rows] + [(None,), ([],), ([None, 1e6],), (rows[0],)]
    got = pixels.moments(spark.createDataFrame(odd, "p array<double>").repartition(7), "p").first()
    flat = np.array([x for r in [*rows, [1e6], rows[0]] for x in r])
    assert got.n == len(flat) and got.mean == pytest.approx(flat.mean(), rel=1e-12) and got.std == pytest.approx(flat.std(), rel=1e-9)


def test_moments_of_nothing(spark):
    got = pixels.moments(spark.createDataFrame([], "p array<double>"), "p").first()
    assert (got.n, got.mean, got.std) == (0, None, None)
    one = pixels.moments(spark.createDataFrame([([7],)], "p array<int>"), "p").first()
    assert (one.n, one.mean, one.std) == (1, 7.0, 0.0)


@pytest.mark.parametrize("size, wanted", [((4, 6), (2, 3)), ((3, 5), (6, 7)), ((8, 8), (8, 8)), ((7, 2), (3, 2))])
def test_resampling(spark, size, wanted):
    """Weights of a triangle along rows, then along columns; a constant stays, a plane stays inside."""
    (h, w), (th, tw) = size, wanted
    image = np.random.default_rng(1).integers(0, 256, (h, w))
    got = spark.createDataFrame([(image.ravel().tolist(),), ([9] * (h * w),), (None,)], "p array<int>").select(pixels.resampled(F.col("p"), h, w, th, tw).alias("r")).collect()
    want = np.array(pixels.weights(h, th)) @ image @ np.array(pixels.weights(w, tw)).T
    assert np.allclose(np.array(got[0].r).reshape(th, tw), want) and np.allclose(got[1].r, 9) and (size != wanted or np.allclose(want, image))
    assert got[2].r is None or all(v is None for v in got[2].r)
    ramp = np.array(pixels.weights(8, 4)) @ np.arange(8.0)
    assert ramp[1:3] == pytest.approx([2.5, 4.5])  # the middle of each pair


def test_pixels_add_floats_as_floats(spark, tmp_path):
    """Three entries that come out one lower where 1 is added to them as doubles."""
    import duckdb

    entries = [-0.03529411926865578, 0.011764705181121826, -0.019607845693826675, -1.0, 1.0, 2.0]
    where = str(tmp_path / "e")
    spark.createDataFrame([(1, 0, entries)], "vec_id bigint, label int, embedding array<float>").write.parquet(where)
    got = spark.read.parquet(where).select(bindings.pixels().alias("p")).first().p
    want = duckdb.execute(f"WITH embeddings AS (SELECT * FROM '{where}/*.parquet'), {bindings.PIXELS} SELECT p FROM pixels").fetchone()[0]
    assert got == want == [123, 129, 125, 0, 255, 255]


def test_deviation_in_the_middle_of_two_rounded_ones(spark):
    """The exact deviation is 15.875; SQL engines' running sums stay just below."""
    import duckdb

    image = [100, 140, 145, 139, 153, 137, 127, 129, 134, 108, 132, 131, 93, 113, 143, 110, 115, 129, 131, 134, 135, 108, 118, 97, 146, 125, 127, 140, 125, 125, 153, 129]
    image += [116, 95, 131, 132, 132, 163, 141, 108, 117, 130, 110, 121, 116, 139, 132, 89, 123, 130, 114, 121, 153, 144, 129, 108, 116, 121, 115, 129, 116, 148, 107, 155]
    got = pixels.statistics(spark.createDataFrame([(1, image)], "k int, p array<int>"), "k", "p").first()
    want = duckdb.execute("SELECT floor(list_stddev_pop(?::DOUBLE[]) * 100e0 + 0.5) / 100e0", [image]).fetchone()[0]
    assert got.std == want == 15.87
