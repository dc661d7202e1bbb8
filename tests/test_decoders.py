"""Pictures written and read by the JVM's own image library, and damaged ones."""

import struct
import zlib

import numpy as np
import pytest

from reuselens.functions.alignment import resized
from reuselens.sources import blobs
from reuselens.sources.decoders import any_pixels


def _bitmap(x):
    h, w, _ = x.shape
    rows = b"".join(r[:, ::-1].tobytes() + b"\0" * (-3 * w % 4) for r in x[::-1])
    return struct.pack("<2sIHHI", b"BM", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(rows), 2835, 2835, 0, 0) + rows


def _from_bitmap(b):
    at, w, h = struct.unpack_from("<I", b, 10)[0], *struct.unpack_from("<ii", b, 18)
    depth = struct.unpack_from("<H", b, 28)[0]
    size = -(-w * depth // 32) * 4
    rows = np.frombuffer(b, np.uint8, size * h, at).reshape(h, size)[::-1]
    if depth == 8:
        shades = np.frombuffer(b, np.uint8, 1024, at - 1024).reshape(256, 4)[:, 2::-1]
        return shades[rows[:, :w]]
    return rows[:, : 3 * w].reshape(h, w, 3)[..., ::-1]


class Java:
    def __init__(self, spark):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.jvm.java.lang.System.setProperty("java.awt.headless", "true")
        self.io = self.jvm.javax.imageio.ImageIO

    def image(self, content):
        return self.io.read(self.jvm.java.io.ByteArrayInputStream(bytearray(content)))

    def read(self, content):
        out = self.jvm.java.io.ByteArrayOutputStream()
        assert self.io.write(self.image(content), "bmp", out)
        return _from_bitmap(bytes(out.toByteArray()))

    def typed(self, x, kind):
        """The picture in another of the library's pixel types."""
        own = self.image(_bitmap(x))
        out = self.jvm.java.awt.image.BufferedImage(own.getWidth(), own.getHeight(), kind)
        g = out.createGraphics()
        g.drawImage(own, 0, 0, None)
        g.dispose()
        return out

    def write(self, image, form, progressive=False, quality=None, interval=None):
        writer = self.io.getImageWritersByFormatName(form).next()
        out = self.jvm.java.io.ByteArrayOutputStream()
        writer.setOutput(self.io.createImageOutputStream(out))
        param = writer.getDefaultWriteParam()
        if progressive:
            param.setProgressiveMode(self.jvm.javax.imageio.ImageWriteParam.MODE_DEFAULT)
        if quality is not None:
            param.setCompressionMode(self.jvm.javax.imageio.ImageWriteParam.MODE_EXPLICIT)
            param.setCompressionQuality(quality)
        meta = None
        if interval:
            meta = writer.getDefaultImageMetadata(self.jvm.javax.imageio.ImageTypeSpecifier(image), param)
            tree = meta.getAsTree("javax_imageio_jpeg_image_1.0")
            node = self.jvm.javax.imageio.metadata.IIOMetadataNode("dri")
            node.setAttribute("interval", str(interval))
            tree.getLastChild().insertBefore(node, tree.getLastChild().getFirstChild())
            meta.setFromTree("javax_imageio_jpeg_image_1.0", tree)
        writer.write(None, self.jvm.javax.imageio.IIOImage(image, None, meta), param)
        writer.getOutput().flush()
        return bytes(out.toByteArray())


@pytest.fixture(scope="module")
def java(spark):
    return Java(spark)


def _picture(h, w, seed=1):
    rng = np.random.default_rng(seed)
    x = resized(rng.integers(0, 256, (5, 6, 3)).astype(float), h, w)
    x[h // 4 : h // 2, w // 4 : w // 2] = rng.integers(0, 256, 3)
    return np.rint(x + rng.normal(0, 6, x.shape)).clip(0, 255).astype(np.uint8)


GRAY, RGB, ARGB, INDEXED, BINARY = 10, 1, 2, 13, 12  # the library's numbers of pixel types


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("size", [(48, 64), (37, 51), (8, 8), (1, 1), (3, 200), (130, 17)])
@pytest.mark.parametrize("kind", [RGB, GRAY])
def test_jpeg(java, size, progressive, kind):
    content = java.write(java.typed(_picture(*size), kind), "jpg", progressive, 0.9)
    found, want = any_pixels(content), java.read(content)
    assert found.shape == want.shape
    gap = np.abs(found.astype(int) - want)
    assert gap.max() <= 4 and gap.mean() < 0.7
    assert (b"\xff\xc2" in content) == progressive


@pytest.mark.parametrize("quality", [0.05, 0.5, 1.0])
@pytest.mark.parametrize("progressive", [False, True])
def test_jpeg_of_any_quality(java, quality, progressive):
    content = java.write(java.typed(_picture(60, 90, 4), RGB), "jpg", progressive, quality)
    gap = np.abs(any_pixels(content).astype(int) - java.read(content))
    assert gap.max() <= 4 and gap.mean() < 0.7


@pytest.mark.parametrize("interval", [1, 3, 1000])
def test_jpeg_with_restarts(java, interval):
    content = java.write(java.typed(_picture(70, 90), RGB), "jpg", interval=interval)
    assert b"\xff\xdd\x00\x04" in content and (b"\xff\xd0" in content) == (interval < 1000)
    assert np.abs(any_pixels(content).astype(int) - java.read(content)).max() <= 4


@pytest.mark.parametrize("kind", [RGB, ARGB, GRAY, INDEXED, BINARY])
@pytest.mark.parametrize("laced", [False, True])
@pytest.mark.parametrize("size", [(33, 47), (1, 1), (5, 3)])
def test_png(java, kind, laced, size):
    image = java.typed(_picture(*size), kind)
    content = java.write(image, "png", laced)
    assert content[28] == laced
    places = [(x, y) for y in range(size[0]) for x in range(size[1])]
    if kind == GRAY:  # its colours are converted, its samples are not
        want = np.array([image.getRaster().getSample(x, y, 0) * 0x010101 for x, y in places])
    else:
        want = np.array([image.getRGB(x, y) & 0xFFFFFF for x, y in places])
    assert (any_pixels(content) == np.stack([want >> 16, want >> 8 & 255, want & 255], axis=1).reshape(*size, 3)).all()


def _png(rows, w, depth, colour, extra=b""):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, len(rows), depth, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + extra + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def test_png_filters_by_hand():
    # one row for each filter, one byte a pixel; worked out from the definitions
    rows = [bytes([0, 10, 20, 30]), bytes([1, 10, 10, 10]), bytes([2, 1, 1, 1]), bytes([3, 5, 5, 5]), bytes([4, 1, 2, 250])]
    want = [[10, 20, 30], [10, 20, 30], [11, 21, 31], [10, 20, 30], [11, 22, 24]]
    assert any_pixels(_png(rows, 3, 8, 0))[..., 0].tolist() == want
    wide = [bytes([0, 1, 255, 2, 255, 3, 0])]
    assert any_pixels(_png(wide, 1, 16, 2))[0, 0].tolist() == [1, 2, 3]
    assert any_pixels(_png([bytes([0, 0b00011011])], 4, 2, 0))[0, :, 0].tolist() == [0, 85, 170, 255]


def test_damage_gives_none(java):
    whole = java.write(java.typed(_picture(60, 80), RGB), "jpg", quality=0.9), java.write(java.typed(_picture(60, 80), RGB), "jpg", True, 0.9), java.write(java.typed(_picture(40, 50), RGB), "png")
    for content in whole:
        assert any_pixels(content) is not None
        for cut in (0, 3, 20, 100, len(content) // 2, len(content) - 3):
            assert any_pixels(content[:cut]) is None
    png = bytearray(whole[2])
    png[len(png) // 2] ^= 1
    assert any_pixels(bytes(png)) is None
    huge = _png([bytes([0, 1])], 1, 8, 0).replace(struct.pack(">II", 1, 1), struct.pack(">II", 1 << 30, 1 << 30), 1)
    assert any_pixels(huge) is None and any_pixels(b"GIF89a") is None and any_pixels(b"P6 x y 255 ") is None
    rng = np.random.default_rng(0)
    for k in range(60):  # never an error, whatever the damage
        bad = bytearray(whole[k % 3])
        for at in rng.integers(0, len(bad), 5):
            bad[at] = rng.integers(0, 256)
        any_pixels(bytes(bad))


def test_folder_of_photographs(spark, java, tmp_path):
    x = _picture(40, 60)
    (tmp_path / "a.jpg").write_bytes(java.write(java.typed(x, RGB), "jpg", True, 0.95))
    (tmp_path / "b.png").write_bytes(java.write(java.typed(x, RGB), "png"))
    (tmp_path / "c.jpg").write_bytes(b"\xff\xd8\xff\xe0 no picture")
    found = {r.url[-5:]: r for r in blobs.read_images(spark, str(tmp_path), longest=30).collect()}
    assert (found["b.png"].h, found["b.png"].w, len(found["b.png"].data)) == (20, 30, 1800)
    a, b = (np.frombuffer(found[k].data, np.uint8).astype(int) for k in ("a.jpg", "b.png"))
    assert np.abs(a - b).mean() < 6
    assert found["c.jpg"].data is None and found["c.jpg"].h is None
