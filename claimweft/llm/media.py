"""Media columns: progressive JPEG in binary columns, read into full-resolution RGB tensors.

``decode`` reads any baseline-precision Huffman-coded progressive JPEG: each scan adds a spectral band or one more bit
of precision to the coefficient arrays of its components. Where a scan's Huffman table has a single symbol, so that all
its codes are equally wide, the scan is read with numpy in one step; other scans are read symbol by symbol.

``encode_bytes`` stores arbitrary bytes losslessly as the quantised coefficients of a 4:2:0 progressive JPEG, the unit
that the format keeps exactly: in an AC coefficient a byte is one of the 256 values of magnitude class 8, in a DC
coefficient one of 256 values which alternate between two ranges, so that differences stay in one class; all are within
what 8-bit samples can give. The number of bytes is in a comment segment.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import lean, ship, slices, table, written

PAD_UNIT = 576
PAD_BYTE = 255
#: Minimum coded units in a row of the stored image; 65535 samples are the format's limit.
MCU_COLUMNS = 4095
COMMENT = b"payload-bytes:"


def _zigzag() -> np.ndarray:
    """Row-major position of the k-th coefficient: along anti-diagonals, up on even ones and down on odd ones."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.asarray([8 * y + x for y, x in cells])


ZIGZAG = _zigzag()
_K = np.arange(8)
#: What is added to a byte in the even and odd DC coefficients of a component: halves differ by 256 to 511 (class 9).
DC_EVEN, DC_ODD = -1022, -256
#: Row u, column x: the 8-point DCT-II basis.
BASIS = np.where(_K[:, None] == 0, np.sqrt(0.125), 0.5 * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16)).astype(np.float32)


# ---- writing ------------------------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, marker, len(body) + 2) + body


def _one_symbol(kind: int, slot: int, symbol: int) -> bytes:
    return _segment(0xC4, bytes([kind << 4 | slot, 1, *[0] * 15, symbol]))


def _scan(parts: list[tuple[int, int]], low: int, high: int, before: int, after: int, data: bytes) -> bytes:
    head = bytes([len(parts)]) + b"".join(bytes([c, t]) for c, t in parts) + bytes([low, high, before << 4 | after])
    return _segment(0xDA, head) + data.replace(b"\xff", b"\xff\x00")


def _bits(rows: np.ndarray) -> bytes:
    flat = rows.reshape(-1)
    return np.packbits(np.concatenate([flat, np.ones(-len(flat) % 8, flat.dtype)])).tobytes()


def _mcu_blocks(rows: int, columns: int) -> np.ndarray:
    """(units, 4): the raster numbers of the luma blocks of each minimum coded unit."""
    r, c = np.divmod(np.arange(rows * columns), columns)
    return np.stack([(2 * r + i) * 2 * columns + 2 * c + j for i in (0, 1) for j in (0, 1)], axis=1)


def encode_bytes(payload: bytes) -> bytes:
    """A progressive JPEG from which ``decode_bytes`` gives payload back. Empty payloads are refused."""
    if not payload:
        raise ValueError("nothing to store")
    units = -(-len(payload) // 384)
    rows = -(-units // MCU_COLUMNS)
    columns = -(-units // rows)
    if rows > MCU_COLUMNS:
        raise ValueError("more bytes than one image holds")
    units = rows * columns
    b = np.frombuffer(payload.ljust(384 * units, bytes([PAD_BYTE])), np.uint8).astype(np.int16)
    luma = _mcu_blocks(rows, columns)
    planes = [b[: 256 * units].reshape(-1, 64), b[256 * units : 320 * units].reshape(-1, 64), b[320 * units :].reshape(-1, 64)]
    order = [luma.reshape(-1), np.arange(units), np.arange(units)]
    # DC, in coded order of each component
    dc, diff = [], []
    for plane, o in zip(planes, order):
        v = plane[o, 0] + np.where(np.arange(len(o)) % 2 == 0, DC_EVEN, DC_ODD)
        dc.append(v)
        top = v >> 1
        diff.append(np.diff(top, prepend=0))
    def interleave(x):
        return np.concatenate([x[0].reshape(-1, 4), x[1][:, None], x[2][:, None]], axis=1).reshape(-1)
    d = interleave(diff)
    extra = np.where(d < 0, d + 511, d)
    dc_first = np.concatenate([np.zeros((len(d), 1), np.uint8), (extra[:, None] >> np.arange(8, -1, -1) & 1).astype(np.uint8)], axis=1)
    all3 = [(1, 0x00), (2, 0x00), (3, 0x00)]
    out = [b"\xff\xd8", _segment(0xFE, COMMENT + str(len(payload)).encode()), _segment(0xDB, bytes([0]) + bytes([1]) * 64),
           _segment(0xC2, struct.pack(">BHHB", 8, 16 * rows, 16 * columns, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
           _one_symbol(0, 0, 9), _one_symbol(1, 0, 7), _one_symbol(1, 1, 0),
           _scan(all3, 0, 0, 0, 1, _bits(dc_first))]
    for low, high in ((1, 5), (6, 63)):
        for c, plane in enumerate(planes):  # code 0 and seven bits for each coefficient
            out.append(_scan([(c + 1, 0x00)], low, high, 0, 1, (plane[:, low : high + 1] >> 1).astype(np.uint8).tobytes()))
    out.append(_scan(all3, 0, 0, 1, 0, _bits((interleave(dc) & 1).astype(np.uint8))))
    for c, plane in enumerate(planes):  # an end of block and a bit for each of the 63 coefficients
        ac = plane[:, 1:]
        fine = np.zeros((len(plane), 64), np.uint8)
        fine[:, 1:] = np.where(ac >= 128, ac, 255 - ac) & 1
        out.append(_scan([(c + 1, 0x01)], 1, 63, 1, 0, np.packbits(fine, axis=1).tobytes()))
    return b"".join(out) + b"\xff\xd9"


# ---- reading ------------------------------------------------------------------------------------------------------


class _Bits:
    """The bits of one entropy-coded segment, byte stuffing removed; ones follow its end."""

    def __init__(self, data: bytes):
        self.data = data
        self.at, self.value, self.have = 0, 0, 0

    def take(self, n: int) -> int:
        while self.have < n:
            chunk = self.data[self.at : self.at + 8] or b"\xff"
            self.value = (self.value & ((1 << self.have) - 1)) << 8 * len(chunk) | int.from_bytes(chunk, "big")
            self.have += 8 * len(chunk)
            self.at += 8
        self.have -= n
        return self.value >> self.have & ((1 << n) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("no such Huffman code")

    def signed(self, n: int) -> int:
        v = self.take(n) if n else 0
        return v if not n or v >> (n - 1) else v - (1 << n) + 1


def _codes(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    out, code, i = {}, 0, 0
    for n, k in enumerate(counts, 1):
        for _ in range(k):
            out[n, code] = symbols[i]
            code, i = code + 1, i + 1
        code <<= 1
    return out


def _uniform(codes: dict[tuple[int, int], int]) -> tuple[int, int] | None:
    """(length, symbol) if the table has one symbol only."""
    return None if len(codes) != 1 else next((n, s) for (n, _), s in codes.items())


def _unpack(data: bytes, rows: int, width: int) -> np.ndarray | None:
    if len(data) * 8 < rows * width:
        return None
    return np.unpackbits(np.frombuffer(data, np.uint8), count=rows * width).reshape(rows, width)


def _number(bits: np.ndarray) -> np.ndarray:
    return bits.astype(np.int32) @ (1 << np.arange(bits.shape[-1] - 1, -1, -1, dtype=np.int32))


class Image:
    """Size, components and coefficient arrays (blocks down, blocks across, 64 in zigzag order) of a progressive JPEG."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        self.comments: list[bytes] = []
        self.tables: dict[int, np.ndarray] = {}
        self.codes: dict[tuple[int, int], dict] = {}
        self.restart = 0
        at = 2
        while at < len(data):
            if data[at] != 255:
                raise ValueError("a marker was expected")
            marker = data[at + 1]
            if marker == 0xD9:
                break
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xFE:
                self.comments.append(body)
            elif marker == 0xDB:
                self._quantisation(body)
            elif marker == 0xC2:
                self._frame(body)
            elif marker == 0xC4:
                self._huffman(body)
            elif marker == 0xDD:
                self.restart = int.from_bytes(body[:2], "big")
            elif marker == 0xDA:
                segments = []
                while True:  # up to the next marker that isn't a restart
                    end = data.find(b"\xff", at)
                    start = at
                    while end >= 0 and data[end + 1] == 0:
                        end = data.find(b"\xff", end + 2)
                    end = len(data) if end < 0 else end
                    segments.append(data[start:end].replace(b"\xff\x00", b"\xff"))
                    at = end
                    if end < len(data) and 0xD0 <= data[end + 1] <= 0xD7:
                        at = end + 2
                        continue
                    break
                self._read_scan(body, segments)
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("only Huffman-coded progressive JPEG is read")

    def _quantisation(self, body: bytes) -> None:
        while body:
            wide, slot = body[0] >> 4, body[0] & 15
            n = 128 if wide else 64
            self.tables[slot] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int32)
            body = body[1 + n :]

    def _huffman(self, body: bytes) -> None:
        while body:
            n = sum(body[1:17])
            self.codes[body[0] >> 4, body[0] & 15] = _codes(body[1:17], body[17 : 17 + n])
            body = body[17 + n :]

    def _frame(self, body: bytes) -> None:
        precision, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        if precision != 8:
            raise ValueError("samples of 8 bits are read")
        parts = [body[6 + 3 * i : 9 + 3 * i] for i in range(n)]
        self.parts = [{"id": p[0], "h": p[1] >> 4, "v": p[1] & 15, "q": p[2]} for p in parts]
        self.hmax, self.vmax = max(p["h"] for p in self.parts), max(p["v"] for p in self.parts)
        self.across, self.down = -(-self.width // (8 * self.hmax)), -(-self.height // (8 * self.vmax))
        for p in self.parts:
            p["coef"] = np.zeros((self.down * p["v"], self.across * p["h"], 64), np.int32)
            p["size"] = (-(-(-(-self.height * p["v"] // self.vmax)) // 8), -(-(-(-self.width * p["h"] // self.hmax)) // 8))

    def _units(self, parts: list[dict]) -> tuple[list[list[tuple[int, np.ndarray]]], int]:
        """For each component its block numbers in coded order, as (units, blocks a unit); and the number of units."""
        if len(parts) == 1:
            p = parts[0]
            y, x = np.divmod(np.arange(p["size"][0] * p["size"][1]), p["size"][1])
            return [(y * p["coef"].shape[1] + x)[:, None]], len(y)
        r, c = np.divmod(np.arange(self.down * self.across), self.across)
        out = []
        for p in parts:
            out.append(np.stack([(p["v"] * r + i) * p["coef"].shape[1] + p["h"] * c + j for i in range(p["v"]) for j in range(p["h"])], axis=1))
        return out, len(r)

    def _read_scan(self, head: bytes, segments: list[bytes]) -> None:
        n = head[0]
        named = {p["id"]: p for p in self.parts}
        parts = [named[head[1 + 2 * i]] for i in range(n)]
        slots = [head[2 + 2 * i] for i in range(n)]
        low, high, before, after = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
        blocks, units = self._units(parts)
        step = self.restart or units
        for k, data in enumerate(segments):
            own = [b[k * step : (k + 1) * step] for b in blocks]
            if not len(own[0]):
                continue
            if low == 0:
                self._dc(parts, slots, own, data, before, after)
            elif before == 0:
                self._ac_first(parts[0], self.codes[1, slots[0] & 15], own[0][:, 0], data, low, high, after)
            else:
                self._ac_refine(parts[0], self.codes[1, slots[0] & 15], own[0][:, 0], data, low, high, after)

    def _dc(self, parts: list[dict], slots: list[int], blocks: list[np.ndarray], data: bytes, before: int, after: int) -> None:
        units, widths = len(blocks[0]), [b.shape[1] for b in blocks]
        each = sum(widths)
        splits = np.cumsum([0, *widths])
        flats = [p["coef"].reshape(-1, 64) for p in parts]
        if before:
            bits = _unpack(data, units, each)
            for f, b, a, e in zip(flats, blocks, splits, splits[1:]):
                f[b, 0] |= bits[:, a:e].astype(np.int32) << after
            return
        codes = [self.codes[0, s >> 4] for s in slots]
        one = {_uniform(c) for c in codes}
        if len(one) == 1 and None not in one:
            (length, size), = one
            bits = _unpack(data, units * each, length + size)
            if bits is not None:
                v = _number(bits[:, length:])
                d = np.where(v >> max(size - 1, 0) & 1, v, v - (1 << size) + 1).reshape(units, each) if size else np.zeros((units, each), np.int32)
                for f, b, a, e in zip(flats, blocks, splits, splits[1:]):
                    f[b.reshape(-1), 0] = np.cumsum(d[:, a:e].reshape(-1)) << after
                return
        read, last = _Bits(data), [0] * len(parts)
        for u in range(units):
            for i, (f, b) in enumerate(zip(flats, blocks)):
                for block in b[u]:
                    last[i] += read.signed(read.symbol(codes[i]))
                    f[block, 0] = last[i] << after

    @staticmethod
    def _ac_first(part: dict, codes: dict, blocks: np.ndarray, data: bytes, low: int, high: int, after: int) -> None:
        f = part["coef"].reshape(-1, 64)
        one = _uniform(codes)
        if one and 0 < one[1] < 16:
            length, size = one
            if length + size == 8:  # whole bytes
                v = np.frombuffer(data, np.uint8, len(blocks) * (high - low + 1)).astype(np.int32) & ((1 << size) - 1)
            else:
                v = _number(_unpack(data, len(blocks) * (high - low + 1), length + size)[:, length:])
            v = np.where(v >> (size - 1) & 1, v, v - (1 << size) + 1).reshape(len(blocks), -1)
            f[blocks, low : high + 1] = v << after
            return
        read, skip = _Bits(data), 0
        for block in blocks:
            if skip:
                skip -= 1
                continue
            k = low
            while k <= high:
                run, size = divmod(read.symbol(codes), 16)
                if size:
                    k += run
                    f[block, k] = read.signed(size) * (1 << after)
                elif run == 15:
                    k += 15
                else:
                    skip = (1 << run) - 1 + (read.take(run) if run else 0)
                    break
                k += 1

    @staticmethod
    def _ac_refine(part: dict, codes: dict, blocks: np.ndarray, data: bytes, low: int, high: int, after: int) -> None:
        f = part["coef"].reshape(-1, 64)
        one = _uniform(codes)
        bit = 1 << after
        if one and one[1] == 0:
            band = f[blocks, low : high + 1]
            if band.all():
                bits = _unpack(data, len(blocks), one[0] + high - low + 1)[:, one[0] :]
                f[blocks, low : high + 1] = band + np.sign(band) * (bits.astype(np.int32) << after)
                return
        read, skip = _Bits(data), 0
        for block in blocks:
            c, k = f[block], low
            while not skip and k <= high:
                run, size = divmod(read.symbol(codes), 16)
                new = 0
                if size:
                    new = bit if read.take(1) else -bit
                elif run < 15:
                    skip = (1 << run) + (read.take(run) if run else 0)
                    break
                while k <= high:  # over ``run`` zeros, correcting what is not zero
                    if c[k]:
                        if read.take(1):
                            c[k] += bit if c[k] > 0 else -bit
                    elif run == 0:
                        break
                    else:
                        run -= 1
                    k += 1
                if new and k <= high:
                    c[k] = new
                k += 1
            if skip:
                for k in range(k, high + 1):
                    if c[k] and read.take(1):
                        c[k] += bit if c[k] > 0 else -bit
                skip -= 1

    def rgb(self) -> np.ndarray:
        """(height, width, 3) 8-bit tensor: inverse DCT, chroma repeated to full resolution, colour transform."""
        planes = []
        for p in self.parts:
            down, across, _ = p["coef"].shape
            c = np.empty((down * across, 64), np.float32)
            c[:, ZIGZAG] = p["coef"].reshape(-1, 64) * self.tables[p["q"]]
            x = np.matmul(np.matmul(BASIS.T, c.reshape(-1, 8, 8)), BASIS)
            plane = x.reshape(down, across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * down, 8 * across) + 128
            plane = np.clip(np.rint(plane), 0, 255)
            if p["v"] != self.vmax:
                plane = np.repeat(plane, self.vmax // p["v"], axis=0)
            if p["h"] != self.hmax:
                plane = np.repeat(plane, self.hmax // p["h"], axis=1)
            planes.append(plane[: self.height, : self.width])
        if len(planes) == 1:
            return np.repeat(planes[0].astype(np.uint8)[:, :, None], 3, axis=2)
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        out = np.empty((*y.shape, 3), np.float32)
        out[:, :, 0] = y + 1.402 * cr
        out[:, :, 1] = y - 0.344136 * cb - 0.714136 * cr
        out[:, :, 2] = y + 1.772 * cb
        return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def decode(data: bytes) -> Image:
    return Image(data)


def decode_bytes(image: Image) -> bytes:
    """The bytes that ``encode_bytes`` stored."""
    n = int(next(c for c in image.comments if c.startswith(COMMENT))[len(COMMENT) :])
    luma = _mcu_blocks(image.down, image.across).reshape(-1)
    out = []
    for p, order in zip(image.parts, (luma, None, None)):
        c = p["coef"].reshape(-1, 64)
        b = np.where(c < 0, c + 255, c)
        coded = c[:, 0] if order is None else c[order, 0]
        dc = coded - np.where(np.arange(len(coded)) % 2 == 0, DC_EVEN, DC_ODD)
        if order is None:
            b[:, 0] = dc
        else:
            b[order, 0] = dc
        out.append(b.astype(np.uint8).tobytes())
    return b"".join(out)[:n]


def features(rgb: np.ndarray) -> str:
    """Size, mean and deviation of each channel, and a checksum of the tensor."""
    flat = rgb.reshape(-1, 3)
    total = flat.sum(axis=0, dtype=np.int64)
    square = np.einsum("ij,ij->j", flat, flat, dtype=np.int64, casting="unsafe")
    n = len(flat)
    mean = [int(t) / n for t in total]
    dev = [max(0.0, int(s) / n - m * m) ** 0.5 for s, m in zip(square, mean)]
    return f"{rgb.shape[1]}x{rgb.shape[0]} mean {mean[0]:.4f} {mean[1]:.4f} {mean[2]:.4f} dev {dev[0]:.4f} {dev[1]:.4f} {dev[2]:.4f} crc {zlib.crc32(np.ascontiguousarray(rgb)):08x}"


def padded(text: bytes) -> bytes:
    return text.ljust(max(PAD_UNIT, -(-len(text) // PAD_UNIT) * PAD_UNIT), bytes([PAD_BYTE]))


def store_texts(docs: DataFrame) -> DataFrame:
    """Texts (null: empty) as progressive JPEG: doc_id, n_bytes, media (binary)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([encode_bytes(padded(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "doc_id long, n_bytes long, media binary")


def read_tensors(media: DataFrame, column: str = "media") -> DataFrame:
    """Add height, width and rgb (binary, row-major 8-bit samples) to a table with progressive JPEG in ``column``.

    Null media give nulls; other columns stay; a clashing name is replaced. What isn't a progressive JPEG fails.
    """
    ship(media.sparkSession)
    media = media.drop("height", "width", "rgb")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                data = one.column(column)[0].as_py()
                rgb = None if data is None else decode(data).rgb()
                more = [pa.array([None if rgb is None else rgb.shape[k]], pa.int32()) for k in (0, 1)] + [pa.array([None if rgb is None else rgb.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([*one.columns, *more], [*one.schema.names, "height", "width", "rgb"])

    return media.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema) + ", height int, width int, rgb binary")


def digest(media: DataFrame) -> DataFrame:
    """Read media of ``store_texts`` back: payload digests, the media's own, and features of the decoded tensor.

    Null media give nulls, repeated rows repeated digests, an empty table an empty one; what isn't such a JPEG fails.
    """

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(6)]
            for data in batch.column("media").to_pylist():
                if data is None:
                    for c in cols:
                        c.append(None)
                    continue
                image = decode(data)
                payload = decode_bytes(image)
                for c, v in zip(cols, (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), features(image.rgb()))):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return media.mapInArrow(lean(run), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_media_columns(spark, sf_dir: str) -> DataFrame:
    """All texts stored as a table of media, and what is read back from it. A null text is an empty one.

    The tensors' features are returned; the tensors themselves, twice the size of the texts, are given by ``read_tensors``.
    """
    return digest(written(store_texts(table(spark, sf_dir, "documents")), "media"))
