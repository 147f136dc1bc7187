"""Media columns: MPEG audio. Streams are written, resynchronised and read frame by frame, with tags, VBR tables and checksums."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Fixed values of the format: kbit/s by version class and layer, and samples a second by version.
BITRATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    layer: int
    protected: bool
    kbps: int
    rate: int
    size: int
    samples: int
    mono: bool

    @property
    def side(self) -> int:
        """Bytes of side information (layer III)."""
        return 0 if self.layer != 3 else (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


@lru_cache(4096)
def header_of(four: bytes) -> Header | None:
    """The frame header in four bytes, or None if they are none (free-format frames, whose length no header gives, included)."""
    if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
        return None
    version, layer = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3)
    rate_at, bitrate_at = four[2] >> 2 & 3, four[2] >> 4
    if version == 1 or layer == 4 or rate_at == 3 or bitrate_at in (0, 15) or four[3] & 3 == 2:
        return None
    kbps = BITRATES[1 if version == 3 else 2, layer][bitrate_at]
    rate, pad = RATES[version][rate_at], four[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 3 else 576
    size = (12000 * kbps // rate + pad) * 4 if layer == 1 else samples // 8 * kbps * 1000 // rate + pad
    return Header(version, layer, not four[1] & 1, kbps, rate, size, samples, four[3] >> 6 == 3)


@lru_cache(65536)
def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, start 0xFFFF."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def _frame_head(kbps: int, protected: bool = True) -> bytes:
    """Header of an MPEG-1 layer III mono frame at 44.1 kHz with its checksum and empty side information."""
    head = bytes((0xFF, 0xFA | (not protected), BITRATES[1, 3].index(kbps) << 4, 0xC0))
    side = bytes(17)
    return head + struct.pack(">H", crc16(head[2:] + side)) + side if protected else head + side


#: Bytes that the ancillary part of a frame holds, by kbit/s.
ROOM = {kbps: header_of(_frame_head(kbps)[:4]).size - 23 for kbps in BITRATES[1, 3][1:]}
_HEADS = {kbps: _frame_head(kbps) for kbps in ROOM}
_OWNER = b"loamline"


def store(payload: bytes, text_bytes: int | None = None) -> bytes:
    """A layer III stream that carries the payload in the ancillary bytes of silent frames: an ID3v2 tag with the
    lengths, a Xing frame (frames, bytes, seek table, delays), checksummed frames, an ID3v1 tag. Equal payloads, equal streams."""
    private = b"PRIV" + struct.pack(">I", 9 + 16) + b"\0\0" + _OWNER + b"\0" + struct.pack(">QQ", len(payload), len(payload) if text_bytes is None else text_bytes)
    tag = b"ID3\x04\0\0" + _syncsafe(len(private)) + private
    top = ROOM[320]
    head = _HEADS[320]
    full = len(payload) // top
    frames = [head + payload[i * top : (i + 1) * top] for i in range(full)]
    if rest := payload[full * top :]:
        kbps = next(k for k, room in ROOM.items() if room >= len(rest))
        frames.append(_HEADS[kbps] + rest + bytes(ROOM[kbps] - len(rest)))
    audio = b"".join(frames)
    size = header_of(_frame_head(128, False)[:4]).size
    total, n = size + len(audio), len(frames)
    offsets = [0, size]
    for f in frames[:-1]:
        offsets.append(offsets[-1] + len(f))
    toc = bytes(min(255, 256 * offsets[min(n, 1 + n * i // 100)] // total) if n else 0 for i in range(100))
    xing = b"Xing" + struct.pack(">III", 15, n, total) + toc + struct.pack(">I", 0) + b"LAME loam" + bytes(27)
    first = _frame_head(128, False) + xing
    first += bytes(size - len(first))
    return tag + first + audio + b"TAG" + bytes(124) + b"\xff"


@dataclass
class Stream:
    """What a stream holds. payload: the ancillary bytes of the frames, cut to the length its tag gives (if any)."""

    tags: list[str] = field(default_factory=list)
    vbr: str = ""
    vbr_frames: int | None = None
    vbr_bytes: int | None = None
    vbr_at: int = 0
    toc: tuple[int, ...] = ()
    toc_frames: int = 0
    fields: dict[str, str] = field(default_factory=dict)
    delay: int = 0
    padding: int = 0
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    rate: int = 0
    kbps: dict[int, int] = field(default_factory=dict)
    crc_good: int = 0
    crc_bad: int = 0
    crc_unchecked: int = 0
    resyncs: int = 0
    junk: int = 0
    payload: bytes = b""
    text_bytes: int | None = None

    @property
    def duration(self) -> tuple[int, int]:
        """Exact seconds as a fraction (samples without delay and padding, rate)."""
        return max(0, self.samples - self.delay - self.padding), self.rate or 1

    @property
    def toc_error(self) -> int | None:
        """The greatest distance in bytes between where the seek table puts a place and the frame found there; None without a table.

        A Xing table rounds to a 256th of its bytes, so up to that and a frame's size is no fault.
        """
        n = len(self.offsets)
        if not n or not self.toc or not self.vbr_bytes:
            return None
        if self.vbr == "VBRI":
            said = accumulate(self.toc)
            pairs = [(p, (i + 1) * self.toc_frames) for i, p in enumerate(said) if 0 < (i + 1) * self.toc_frames < n]
        else:
            pairs = [(p * self.vbr_bytes // 256, n * i // 100) for i, p in enumerate(self.toc)]
        return max((abs(p - (self.offsets[k] - self.vbr_at)) for p, k in pairs), default=0)

    def seek(self, sample: int) -> int | None:
        """Byte offset of the frame that holds a sample; None outside. Exact: from the frames, not from the seek table."""
        if not self.offsets or not 0 <= sample < self.samples:
            return None
        return self.offsets[sample * len(self.offsets) // self.samples]


def _frame_at(data: bytes, at: int, end: int, like: Header | None, sure: bool) -> Header | None:
    """The header at a place. Unless sure, the next header (or the end) must confirm it."""
    head = header_of(data[at : at + 4])
    if head is None or at + head.size > end:
        return None
    if like is not None and (head.version, head.layer, head.rate) != (like.version, like.layer, like.rate):
        return None
    if not sure and at + head.size != end:
        after = header_of(data[at + head.size : at + head.size + 4])
        if after is None or (after.version, after.layer, after.rate) != (head.version, head.layer, head.rate):
            return None
    return head


def _vbr(frame: bytes, head: Header, out: Stream) -> bool:
    """Read a VBR table in a frame; whether there is one. Fields that the frame is too short for stay unset."""
    at = 4 + head.side
    if frame[at : at + 4] in (b"Xing", b"Info"):
        out.vbr, flags, p = frame[at : at + 4].decode(), int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8
        found = {}
        for bit, size in ((1, 4), (2, 4), (4, 100), (8, 4)):
            if flags & bit:
                if p + size > len(frame):
                    return True
                found[bit], p = frame[p : p + size], p + size
        number = lambda bit: int.from_bytes(found[bit], "big") if bit in found else None
        out.vbr_frames, out.vbr_bytes, out.toc = number(1), number(2), tuple(found.get(4, b""))
        if frame[p : p + 4] in (b"LAME", b"Lavc", b"Lavf") and len(frame) >= p + 24:
            three = int.from_bytes(frame[p + 21 : p + 24], "big")
            out.delay, out.padding = three >> 12, three & 0xFFF
        return True
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        out.vbr = "VBRI"
        out.vbr_bytes, out.vbr_frames, n, scale, width, out.toc_frames = struct.unpack_from(">IIHHHH", frame, 46)
        width = min(max(width, 1), 4)
        out.toc = tuple(scale * int.from_bytes(frame[62 + i * width : 62 + (i + 1) * width], "big") for i in range(min(n, (len(frame) - 62) // width)))
        return True
    return False


def _words_of(raw: bytes, encoding: int) -> str:
    """The text of an ID3v2 frame: parts between zeros, joined by slashes."""
    text = raw.decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[encoding & 3], "replace")
    return "/".join(x for x in text.split("\0") if x)


def _id3v2(body: bytes, version: int, flags: int, out: Stream) -> int | None:
    """Read the frames of an ID3v2 tag: text frames into fields, and the payload's length from a private frame of ours."""
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    syncsafe = lambda b: sum((x & 0x7F) << 7 * i for i, x in enumerate(reversed(b)))
    at, length = 0, None
    if flags & 0x40 and version >= 3:
        at = syncsafe(body[:4]) if version == 4 else 4 + int.from_bytes(body[:4], "big")
    name_size, head_size = (3, 6) if version == 2 else (4, 10)
    while at + head_size <= len(body) and body[at : at + name_size].isalnum():
        name, raw = body[at : at + name_size].decode("latin-1"), body[at + name_size : at + name_size + (3 if version == 2 else 4)]
        size = syncsafe(raw) if version == 4 else int.from_bytes(raw, "big")
        value = body[at + head_size : at + head_size + size]
        if len(value) < size:
            break
        if name.startswith("T") and value:
            out.fields.setdefault(name, _words_of(value[1:], value[0]))
        if name == "PRIV" and value.startswith(_OWNER + b"\0") and len(value) == len(_OWNER) + 17:
            length, text_bytes = struct.unpack_from(">QQ", value, len(_OWNER) + 1)
            out.text_bytes = text_bytes if text_bytes <= length else None
        at += head_size + size
    return length


def _id3v1(tag: bytes, out: Stream) -> None:
    for name, lo, hi in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97), ("comment", 97, 127)):
        value = tag[lo:hi].split(b"\0")[0].decode("latin-1").strip()
        if value:
            out.fields.setdefault(name, value)
    if tag[125] == 0 and tag[126]:
        out.fields.setdefault("track", str(tag[126]))


def _ape(items: bytes, out: Stream) -> None:
    at = 0
    while at + 8 < len(items):
        size, end = int.from_bytes(items[at : at + 4], "little"), items.find(b"\0", at + 8)
        if end < 0 or end + 1 + size > len(items):
            return
        out.fields.setdefault(items[at + 8 : end].decode("latin-1"), items[end + 1 : end + 1 + size].decode("utf-8", "replace"))
        at = end + 1 + size


# Fixed values of layer II: the bits of a subband's allocation, as (subbands, bits) runs.
ALLOCATION = {
    "a": ((11, 4), (12, 3), (4, 2)),
    "b": ((11, 4), (12, 3), (7, 2)),
    "c": ((2, 4), (6, 3)),
    "d": ((2, 4), (10, 3)),
    "lsf": ((4, 4), (7, 3), (19, 2)),
}


def _allocation(head: Header) -> tuple[tuple[int, int], ...]:
    """The allocation runs of a layer II frame: by version, sampling rate and bit rate a channel."""
    each = head.kbps if head.mono else head.kbps // 2
    if head.version != 3:
        return ALLOCATION["lsf"]
    if each <= 48:
        return ALLOCATION["d" if head.rate == 32000 else "c"]
    return ALLOCATION["a" if each <= 80 or head.rate == 48000 else "b"]


def protected_bits(frame: bytes, head: Header) -> int:
    """How many bits after the checksum it covers, besides the header's last two bytes: side information (layer III), the
    allocations (layer I), the allocations and scale factor selections (layer II)."""
    if head.layer == 3:
        return 8 * head.side
    channels = 1 if head.mono else 2
    joint = 4 * ((frame[3] >> 4 & 3) + 1) if frame[3] >> 6 == 1 else 32  # subbands from here on share their allocation
    if head.layer == 1:
        return 4 * (channels * joint + 32 - joint if channels == 2 else 32)
    bits = "".join(f"{b:08b}" for b in frame[6:60])
    at = used = band = 0
    for count, width in _allocation(head):
        for _ in range(count):
            own = channels if band < joint else 1
            for _ in range(own):
                used += ("1" in bits[at : at + width]) * (channels // own)
                at += width
            band += 1
    return at + 2 * used


def checksum(frame: bytes, head: Header) -> int | None:
    """The checksum that a protected frame should have; None where the frame is too short for what it claims."""
    n = protected_bits(frame, head)
    covered = frame[6 : 6 + (n + 7) // 8]
    if len(covered) * 8 < n:
        return None
    crc, rest = crc16(frame[2:4] + covered[: n // 8]), n % 8
    for i in range(rest):
        bit = covered[-1] >> 7 - i & 1
        crc = (crc << 1 ^ (0x8005 if (crc >> 15) ^ bit else 0)) & 0xFFFF
    return crc


def parse(data: bytes | None) -> Stream:
    """Read a stream: tags at both ends, the VBR table in the first frame, then every frame with its checksum.

    Where no frame starts, the reader goes on byte by byte until a header comes whose successor agrees with it (and with the
    frames before); what it passed counts as junk and one resynchronisation. Damaged frames (bad checksum) count, but
    keep their place and samples. fields holds the tags' text: ID3v2 text frames by their id, ID3v1 fields, APE items; the first of
    a name counts. A checksum is verified in every protected frame of the three layers; a frame too short for what it covers counts as unchecked.
    The checksum inside a LAME tag is not. Null, empty or foreign bytes give a stream without frames, whatever they are.
    """
    data = bytes(data or b"")
    out, at, end, length = Stream(), 0, len(data), None
    while data[at : at + 3] == b"ID3" and at + 10 <= end:
        size = 0
        for b in data[at + 6 : at + 10]:
            size = size << 7 | b & 0x7F
        out.tags.append(f"ID3v2.{data[at + 3]}")
        found = _id3v2(data[at + 10 : min(end, at + 10 + size)], data[at + 3], data[at + 5], out)
        length = found if length is None else length
        at += 10 + size + (10 if data[at + 5] & 0x10 else 0)
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        out.tags.append("ID3v1")
        _id3v1(data[end - 128 : end], out)
        end -= 128
    if end - at >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, _, flags = struct.unpack_from("<III", data, end - 20)
        out.tags.append("APE")
        _ape(data[max(at, end - size) : end - 32], out)
        end = max(at, end - size - (32 if flags & 0x80000000 else 0))
    like, sure, first, parts = None, False, True, []
    while at < end:
        head = _frame_at(data, at, end, like, sure)
        if head is None:
            out.resyncs += 1
            begin = at
            at += 1
            while at < end:
                at = data.find(b"\xff", at, end)
                if at < 0:
                    at = end
                elif (head := _frame_at(data, at, end, like, False)) is not None:
                    break
                else:
                    at += 1
            out.junk += at - begin
            if at >= end:
                break
        like, sure = head, True
        frame = data[at : at + head.size]
        if head.protected:
            due = checksum(frame, head)
            good = due == int.from_bytes(frame[4:6], "big")
            out.crc_unchecked += due is None
            out.crc_good += good
            out.crc_bad += due is not None and not good
        if first and head.layer == 3 and _vbr(frame, head, out):
            out.vbr_at = at
        else:
            out.offsets.append(at)
            out.sizes.append(head.size)
            out.samples += head.samples
            out.kbps[head.kbps] = out.kbps.get(head.kbps, 0) + 1
            parts.append(frame[4 + 2 * head.protected + head.side :])
        out.rate, first = head.rate, False
        at += head.size
    out.payload = b"".join(parts)[:length]
    return out


def pad(text: str | None, unit: int = 64) -> tuple[bytes, int]:
    """A text's UTF-8 bytes (null: none) with bytes 0 up to a positive multiple of unit, and the bytes without them."""
    raw = (text or "").encode("utf-8", "replace")
    return raw + bytes(-len(raw) % unit or (unit if not raw else 0)), len(raw)


def store_media(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text by default) and media: a binary column of MPEG audio that carries the text's bytes.

    Null and empty texts carry 64 bytes 0. Every row, repeated or not, has its stream; a kept column named media gives way.
    """
    small_batches(docs.sparkSession)
    stay = [c for c in (keep if keep is not None else docs.columns) if c != "media" and (keep is not None or c != text)]
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(stay)], F.col(f"`{text}`").alias("__text"))
    kinds = dict(source.dtypes)

    def run(batches):
        for batch in batches:
            media = [store(*pad(t)) for t in batch.column(len(stay)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(media, pa.binary())], names=[*[f"k{i}" for i in range(len(stay))], "media"])

    out = source.mapInArrow(run, ", ".join([*[f"k{i} {kinds[f'k{i}']}" for i in range(len(stay))], "media binary"]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(stay)], "media")


def inspect_media(media: DataFrame, column: str = "media", keep: list[str] | None = None) -> DataFrame:
    """Add `audio`, a struct read from the stored bytes, to the kept columns (all by default).

    audio: tags, fields (their texts by name), vbr (Xing, Info, VBRI or empty) with its frames and bytes, toc_error (bytes; see Stream), frames, samples, rate, duration (seconds; the
    exact value is duration_samples / rate), kbps (mean), crc_good, crc_bad, crc_unchecked (frames too short for what they cover), resyncs, junk bytes, frame_offsets (array: the byte at which each
    frame starts), payload (binary), text_bytes. Null, empty and foreign bytes give no frames, not an error.
    """
    small_batches(media.sparkSession)
    stay = [c for c in (keep if keep is not None else media.columns) if c != "audio"]
    source = media.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(stay)], F.col(f"`{column}`").alias("__media"))
    kinds = dict(source.dtypes)
    kind = pa.struct([
        ("tags", pa.list_(pa.string())), ("vbr", pa.string()), ("vbr_frames", pa.int64()), ("vbr_bytes", pa.int64()), ("frames", pa.int64()), ("samples", pa.int64()),
        ("duration_samples", pa.int64()), ("rate", pa.int32()), ("duration", pa.float64()), ("kbps", pa.float64()), ("crc_good", pa.int64()), ("crc_bad", pa.int64()), ("crc_unchecked", pa.int64()), ("toc_error", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())),
        ("resyncs", pa.int64()), ("junk", pa.int64()), ("frame_offsets", pa.list_(pa.int64())), ("payload", pa.binary()), ("text_bytes", pa.int64()),
    ])

    def row(data):
        s = parse(data)
        n, rate = s.duration
        return {
            "tags": s.tags, "vbr": s.vbr, "vbr_frames": s.vbr_frames, "vbr_bytes": s.vbr_bytes, "frames": len(s.offsets), "samples": s.samples,
            "duration_samples": n, "rate": s.rate, "duration": n / rate, "kbps": sum(k * v for k, v in s.kbps.items()) / max(1, len(s.offsets)),
            "crc_good": s.crc_good, "crc_bad": s.crc_bad, "crc_unchecked": s.crc_unchecked, "toc_error": s.toc_error, "fields": list(s.fields.items()), "resyncs": s.resyncs, "junk": s.junk, "frame_offsets": s.offsets, "payload": s.payload, "text_bytes": s.text_bytes,
        }

    def run(batches):
        for batch in batches:
            rows = [row(b) for b in batch.column(len(stay)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], names=[*[f"k{i}" for i in range(len(stay))], "audio"])

    struct_type = "struct<tags:array<string>,vbr:string,vbr_frames:long,vbr_bytes:long,frames:long,samples:long,duration_samples:long,rate:int,duration:double,kbps:double,crc_good:long,crc_bad:long,crc_unchecked:long,toc_error:long,fields:map<string,string>,resyncs:long,junk:long,frame_offsets:array<long>,payload:binary,text_bytes:long>"
    out = source.mapInArrow(run, ", ".join([*[f"k{i} {kinds[f'k{i}']}" for i in range(len(stay))], f"audio {struct_type}"]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(stay)], "audio")
