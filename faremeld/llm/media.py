"""Media columns: signatures found by Aho-Corasick, confirmed by each format's own structure."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import settle, table

ROW = 192
DECLARED = "audio/wav"

# ---- validators: (bytes, start) to the end of the media, or None if the structure is broken


def png_end(data: bytes, at: int) -> int | None:
    pos, first = at + 8, True
    while pos + 12 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, pos)
        if pos + 12 + size > len(data) or first != (kind == b"IHDR"):
            return None
        if zlib.crc32(data[pos + 4 : pos + 8 + size]) != struct.unpack_from(">I", data, pos + 8 + size)[0]:
            return None
        pos, first = pos + 12 + size, False
        if kind == b"IEND":
            return pos
    return None


def bmp_end(data: bytes, at: int) -> int | None:
    if at + 30 > len(data):
        return None
    size, reserved, offset, header, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", data, at + 2)
    if reserved or header not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or not height:
        return None
    pixels = (width * bits + 31) // 32 * 4 * abs(height)
    return at + size if 14 + header <= offset and offset + pixels <= size <= len(data) - at else None


def riff_end(data: bytes, at: int) -> int | None:
    if at + 12 > len(data) or data[at + 8 : at + 12] not in (b"WAVE", b"WEBP", b"AVI "):
        return None
    end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    pos = at + 12
    while pos + 8 <= end <= len(data):
        pos += 8 + struct.unpack_from("<I", data, pos + 4)[0]
        pos += (pos - at) % 2
    return end if end <= len(data) and end <= pos <= end + 1 and pos > at + 12 else None


def gif_end(data: bytes, at: int) -> int | None:
    if data[at + 4 : at + 6] not in (b"7a", b"9a") or at + 13 > len(data):
        return None

    def table_bytes(flags: int) -> int:
        return 3 << (flags & 7) + 1 if flags & 0x80 else 0

    def blocks(pos: int) -> int | None:
        while pos < len(data):
            if not data[pos]:
                return pos + 1
            pos += 1 + data[pos]
        return None

    pos: int | None = at + 13 + table_bytes(data[at + 10])
    while pos is not None and pos < len(data):
        if data[pos] == 0x3B:
            return pos + 1
        if data[pos] == 0x21:
            pos = blocks(pos + 2)
        elif data[pos] == 0x2C and pos + 10 < len(data):
            pos = blocks(pos + 11 + table_bytes(data[pos + 9]))
        else:
            return None
    return None


def jpeg_end(data: bytes, at: int) -> int | None:
    pos = at + 2
    while pos + 4 <= len(data):
        if data[pos] != 0xFF:
            return None
        kind = data[pos + 1]
        if kind == 0xD9:
            return pos + 2
        size = struct.unpack_from(">H", data, pos + 2)[0]
        if kind in (0x00, 0xFF) or size < 2:
            return None
        pos += 2 + size
        if kind == 0xDA:  # coded data up to the next marker that is neither a stuffed byte nor a restart
            while (pos := data.find(b"\xff", pos)) >= 0 and pos + 1 < len(data) and (data[pos + 1] == 0 or 0xD0 <= data[pos + 1] <= 0xD7):
                pos += 2
            if pos < 0:
                return None
            if data[pos : pos + 2] == b"\xff\xd9":
                return pos + 2
    return None


def ogg_end(data: bytes, at: int) -> int | None:
    pos = at
    while data[pos : pos + 4] == b"OggS" and pos + 27 <= len(data):
        count = data[pos + 26]
        body = sum(data[pos + 27 : pos + 27 + count])
        last, pos = data[pos + 5] & 4, pos + 27 + count + body
        if pos > len(data):
            return None
        if last:
            return pos
    return None


def pdf_end(data: bytes, at: int) -> int | None:
    end = data.find(b"%%EOF", at)
    return end + 5 if end >= 0 and data[at + 5 : at + 6].isdigit() and data.find(b"startxref", at, end) >= 0 else None


#: Magic bytes, the type they tell, the bytes before them, the validator.
SIGNATURES: tuple[tuple[bytes, str, int, Callable[[bytes, int], int | None]], ...] = (
    (b"\x89PNG\r\n\x1a\n", "image/png", 0, png_end),
    (b"BM", "image/bmp", 0, bmp_end),
    (b"RIFF", "riff", 0, riff_end),
    (b"GIF8", "image/gif", 0, gif_end),
    (b"\xff\xd8\xff", "image/jpeg", 0, jpeg_end),
    (b"OggS", "audio/ogg", 0, ogg_end),
    (b"%PDF-", "application/pdf", 0, pdf_end),
)
RIFF_TYPES = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, (magic, *_) in enumerate(SIGNATURES):
        found.add_word(magic.decode("latin-1"), number)
    found.make_automaton()
    return found


def carve(data: bytes | None, magic: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(type, start, end) of every whole media in the bytes, outer ones before those inside them."""
    out = []
    for at, number in magic.iter((data or b"").decode("latin-1")):
        signature, kind, _, ends = SIGNATURES[number]
        start = at + 1 - len(signature)
        if (end := ends(data, start)) is not None:
            out.append((RIFF_TYPES[data[start + 8 : start + 12]] if kind == "riff" else kind, start, end))
    return sorted(out, key=lambda x: (x[1], -x[2]))


def sniff(media: DataFrame) -> DataFrame:
    """Adds `actual_type`, `declared_right` and `carved` to (media, declared_type).

    The actual type is that of whole media at the first byte, else null; the
    declaration is right if it equals it, and unknown (null) if either is. All
    whole media that begin later are in `carved` as (type, start, length); null
    or empty bytes hold none. Columns of these names are replaced; others pass.
    """
    made = ("actual_type", "declared_right", "carved")
    kept = [c for c in media.columns if c not in made]

    @F.pandas_udf("actual_type string, carved array<struct<type:string,start:long,length:long>>")
    def look(blobs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        magic = automaton()
        for blob in blobs:
            rows = []
            for data in blob:
                found = carve(bytes(data) if data is not None else None, magic)
                whole = next((x for x in found if x[1] == 0), None)
                rows.append((whole and whole[0], [{"type": t, "start": a, "length": z - a} for t, a, z in found if (t, a, z) != whole]))
            yield pd.DataFrame(rows, columns=["actual_type", "carved"])

    seen = media.select(*kept).withColumn("_seen", look("media"))
    return seen.select(*kept, F.col("_seen.actual_type").alias("actual_type"), (F.col("declared_type") == F.col("_seen.actual_type")).alias("declared_right"), F.col("_seen.carved").alias("carved"))


# ---- three lossless forms of rows of 192 8-bit samples


def as_wav(samples: bytes) -> bytes:
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(form) + 8 + len(samples), b"WAVE") + form + struct.pack("<4sI", b"data", len(samples)) + samples


def as_bmp(samples: bytes) -> bytes:
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    head = struct.pack("<2sIIIIiiHHIIiiII", b"BM", 54 + 1024 + len(samples), 0, 54 + 1024, 40, ROW, -(len(samples) // ROW), 1, 8, 0, len(samples), 0, 0, 256, 0)
    return head + palette + samples


def as_png(samples: bytes) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = b"".join(b"\0" + samples[i : i + ROW] for i in range(0, len(samples), ROW))
    size = struct.pack(">IIBBBBB", ROW, len(samples) // ROW, 8, 0, 0, 0, 0)
    return SIGNATURES[0][0] + chunk(b"IHDR", size) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def samples_of(data: bytes, kind: str) -> bytes:
    """The samples of a whole media that one of the three forms made."""
    if kind == "audio/wav":
        return data[44:]
    if kind == "image/bmp":
        return data[struct.unpack_from("<I", data, 10)[0] :]
    pos, body = 8, b""
    while pos < len(data):
        size, name = struct.unpack_from(">I4s", data, pos)
        body += data[pos + 8 : pos + 8 + size] if name == b"IDAT" else b""
        pos += 12 + size
    rows = zlib.decompress(body)
    return b"".join(rows[i + 1 : i + 1 + ROW] for i in range(0, len(rows), ROW + 1))


FORMS = (as_wav, as_bmp, as_png)


def stored_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, declared_type, media): each whole text, padded with spaces to rows of 192 bytes, as media.

    The form follows the bytes, so equal texts have equal media; the declared
    type is the same for all, and so wrong for two of the three forms.
    """

    @F.pandas_udf("n_bytes long, media binary")
    def store(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            data = text.encode("utf-8", "surrogatepass")
            padded = data.ljust(max(1, -(-len(data) // ROW)) * ROW)
            rows.append((len(data), FORMS[zlib.crc32(data) % 3](padded)))
        return pd.DataFrame(rows, columns=["n_bytes", "media"])

    made = docs.select("doc_id", store(F.coalesce("text", F.lit(""))).alias("m"))
    return made.select("doc_id", "m.n_bytes", F.lit(DECLARED).alias("declared_type"), "m.media")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = settle(stored_texts(table(spark, sf_dir, "documents")))

    @F.pandas_udf("payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string")
    def read_back(blobs: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        rows = []
        for blob, kind in zip(blobs, kinds):
            data = bytes(blob)
            samples = samples_of(data, kind)
            rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(data), hashlib.sha256(data).hexdigest()))
        return pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"])

    seen = sniff(stored)
    carved = F.array_join(F.transform("carved", lambda c: F.concat_ws("@", c["type"], c["start"].cast("string"), c["length"].cast("string"))), ",")
    feature = F.concat_ws(";", F.col("actual_type"), F.when(F.col("declared_right"), "declared").otherwise("corrected"), F.concat(F.lit("carved="), carved))
    out = seen.select("doc_id", "n_bytes", read_back("media", "actual_type").alias("r"), feature.alias("feature"))
    return out.select("doc_id", "n_bytes", "r.*", "feature")
