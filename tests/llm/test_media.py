import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamline.llm import mpeg, queries


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=5000))
def test_round_trip(payload):
    s = mpeg.parse(mpeg.store(payload))
    assert s.payload == payload and s.crc_bad == 0 and s.resyncs == 0 and s.junk == 0
    assert s.vbr_frames == len(s.offsets) and s.samples == 1152 * len(s.offsets) and s.crc_good == len(s.offsets)


def stream(n=40):
    random.seed(n)
    payload = bytes(random.randrange(256) for _ in range(n * 900))
    return payload, mpeg.store(payload)


def test_resynchronises_over_junk():
    payload, data = stream()
    s = mpeg.parse(data)
    at = s.offsets[7]
    broken = mpeg.parse(data[:at] + b"\xff\xfbjunk\xff\xe0" * 5 + data[at:])
    assert broken.resyncs == 1 and broken.junk == 40 and broken.payload == payload and len(broken.offsets) == len(s.offsets)


def test_a_lost_frame_loses_only_itself():
    payload, data = stream()
    s = mpeg.parse(data)
    cut = mpeg.parse(data[: s.offsets[3] + 10] + data[s.offsets[4] :])
    assert len(cut.offsets) == len(s.offsets) - 1 and cut.resyncs == 1


def test_checksum_finds_damage():
    _, data = stream()
    bad = bytearray(data)
    bad[mpeg.parse(data).offsets[2] + 9] ^= 4
    s = mpeg.parse(bytes(bad))
    assert s.crc_bad == 1 and s.crc_good == len(s.offsets) - 1


def test_seek_and_duration():
    _, data = stream()
    s = mpeg.parse(data)
    assert s.duration == (len(s.offsets) * 1152, 44100)
    assert s.seek(0) == s.offsets[0] and s.seek(1152 * 5 + 3) == s.offsets[5] and s.seek(s.samples) is None
    assert all(data[o] == 0xFF for o in s.offsets)


@pytest.mark.parametrize("four,expected", [("fffb9000", (3, 3, 128, 44100, 417, 1152)), ("fffd9000", (3, 2, 160, 44100, 522, 1152)), ("fff39000", (2, 3, 80, 22050, 261, 576)), ("ffe39000", (0, 3, 80, 11025, 522, 576)), ("ffff9000", (3, 1, 288, 44100, 312, 384))])
def test_headers(four, expected):
    h = mpeg.header_of(bytes.fromhex(four))
    assert (h.version, h.layer, h.kbps, h.rate, h.size, h.samples) == expected


@pytest.mark.parametrize("four", ["fffbf000", "fffb0000", "fffb9c00", "ffeb9000", "fff99000"[:6] + "02", "00000000", "ff"])
def test_no_headers(four):
    assert mpeg.header_of(bytes.fromhex(four)) is None


def test_foreign_tables_and_tags():
    head = bytes.fromhex("fffb9044")
    frame = head + bytes(413)
    vbri = bytearray(frame)
    vbri[36:40] = b"VBRI"
    vbri[40:62] = bytes((0, 1, 0, 0, 0, 75)) + (2085).to_bytes(4, "big") + (4).to_bytes(4, "big") + bytes((0, 2, 0, 1, 0, 2, 0, 2))
    vbri[62:66] = bytes((1, 161, 1, 161))
    s = mpeg.parse(bytes(vbri) + frame * 4 + b"TAG" + bytes(125))
    assert s.vbr == "VBRI" and s.vbr_frames == 4 and s.toc == (417, 417) and len(s.offsets) == 4 and s.tags == ["ID3v1"]
    ape = b"APETAGEX" + (2000).to_bytes(4, "little") + (32).to_bytes(4, "little") + bytes(16)
    assert len(mpeg.parse(frame * 3 + ape).offsets) == 3
    assert mpeg.parse(b"").offsets == [] and mpeg.parse(b"no audio at all").offsets == [] and mpeg.parse(None).payload == b""


def test_query_against_plain_python(spark, sf, corpus):
    rows = {r.doc_id: r for r in queries.op2_mpeg(spark, sf).collect()}
    assert len(rows) == len(corpus)
    for doc_id, text in corpus:
        raw = (text or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = rows[doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        # tag of 45 bytes, a frame of 417 with the table, frames of 1044 bytes that carry 1021 (the last as small as will do), tag of 128
        last = len(padded) % 1021
        rates = (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
        small = next((144000 * k // 44100 for k in rates if 144000 * k // 44100 - 23 >= last), 0) if last else 0
        assert r.media_bytes == 45 + 417 + len(padded) // 1021 * 1044 + small + 128 and r.crc_bad == 0


def test_odd_rows(odd, none):
    out = mpeg.inspect_media(mpeg.store_media(odd, keep=["doc_id", "media", "audio"])).collect()
    assert len(out) == odd.count() and {r.audio.payload for r in out if r.doc_id in (2, 3)} == {bytes(64)}
    assert mpeg.inspect_media(mpeg.store_media(none)).count() == 0
    assert len({r.media for r in out if r.doc_id in (1, 4)}) == 1


def crc_of_bits(bits):
    """The checksum bit by bit, apart from the operator's."""
    crc = 0xFFFF
    for b in bits:
        top = crc >> 15
        crc = crc << 1 & 0xFFFF
        if top != b:
            crc ^= 0x8005
    return crc


def bits_of(data):
    return [b >> i & 1 for b in data for i in range(7, -1, -1)]


# header, its allocation bits with nothing allocated, the scale factor selection bits once the first nibble is set
PROTECTED = [
    ("fffea0c0", 128, 0),  # layer I, mono
    ("fffea000", 256, 0),  # layer I, stereo
    ("fffea050", 4 * (2 * 8 + 24), 0),  # layer I, joint from subband 8
    ("fffca0c0", 44 + 36 + 14, 2),  # layer II, mono, 192 kbit/s: 30 subbands
    ("fffc40c0", 44 + 36 + 8, 2),  # layer II, mono, 64 kbit/s: 27 subbands
    ("fffc10c0", 8 + 18, 2),  # layer II, mono, 32 kbit/s: 8 subbands
    ("fffc18c0", 8 + 30, 2),  # layer II, mono, 32 kbit/s at 32 kHz: 12 subbands
    ("fffca000", 2 * (44 + 36 + 14), 2),  # layer II, stereo, 96 a channel
    ("fffca040", 2 * 16 + 28 + 36 + 14, 2),  # layer II, joint from subband 4
    ("fff480c0", 16 + 21 + 38, 2),  # MPEG-2 layer II, mono
]


@pytest.mark.parametrize("four,n,selection", PROTECTED)
def test_checksums_of_layers_one_and_two(four, n, selection):
    head = bytes.fromhex(four)
    h = mpeg.header_of(head)
    for first in (0x00, 0x10):
        covered = n + (selection if first else 0)
        body = bytearray(h.size - 6)
        body[0] = first
        body[-1] = 7
        crc = crc_of_bits(bits_of(head[2:]) + bits_of(body)[:covered])
        frame = head + crc.to_bytes(2, "big") + bytes(body)
        assert mpeg.protected_bits(frame, h) == covered
        s = mpeg.parse(frame * 4)
        assert (len(s.offsets), s.crc_good, s.crc_bad, s.crc_unchecked) == (4, 4, 0, 0)
        body[(covered - 1) // 8] ^= 1 << 7 - (covered - 1) % 8  # the last bit that it covers
        hurt = head + crc.to_bytes(2, "big") + bytes(body)
        assert mpeg.parse(frame * 2 + hurt + frame).crc_bad == 1


MARKS = st.sampled_from([b"Xing\0\0\0\x0f", b"Info", b"VBRI", b"ID3\x04\0\0\0\0\0\x7f", b"ID3\x02\0\xff\0\0\1\0TT2", b"PRIV\0\0\0\x19\0\0loamline\0", b"TAG" + bytes(125), b"APETAGEX" + b"\xff" * 24, b"LAME", bytes(9), b"\xff" * 40])
HEADS = st.tuples(st.just(0xFF), st.sampled_from([0xFB, 0xFA, 0xFC, 0xFE, 0xF2, 0xF3, 0xF4, 0xE2, 0xE3]), st.integers(0, 255), st.integers(0, 255)).map(bytes)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(HEADS, HEADS.flatmap(lambda h: st.just(h + bytes(max(0, (mpeg.header_of(h).size if mpeg.header_of(h) else 8) - 4)))), MARKS, st.binary(max_size=60)), max_size=12))
def test_any_bytes_are_read(parts):
    data = b"".join(parts)
    s = mpeg.parse(data)
    assert s.junk + sum(s.sizes) <= len(data) and s.duration[0] >= 0
    assert s.text_bytes is None or s.text_bytes < 2**64
    s.toc_error, s.seek(0)


@pytest.mark.parametrize("four", ["fff31800", "fff314c0", "fff310c0", "fff21800", "ffe31800"])
@pytest.mark.parametrize("mark", [b"Xing", b"Info", b"VBRI"])
def test_small_frames_with_a_mark(four, mark):
    head = bytes.fromhex(four)
    h = mpeg.header_of(head)
    for at in (4 + h.side, 36):
        frame = bytearray(head.ljust(h.size, b"\0"))
        frame[at : at + 8] = (mark + b"\0\0\0\x0f")[: max(0, len(frame) - at)]
        s = mpeg.parse(bytes(frame[: h.size]) + head.ljust(h.size, b"\0") * 2)
        assert len(s.offsets) in (2, 3)


def test_tags_give_their_fields():
    frame = bytes.fromhex("fffb9044") + bytes(413)
    text = lambda name, enc, raw: name + (len(raw) + 1).to_bytes(4, "big") + b"\0\0" + bytes([enc]) + raw
    body = text(b"TIT2", 3, "Käse".encode()) + text(b"TPE1", 1, "Ω x".encode("utf-16")) + text(b"TALB", 0, b"caf\xe9\0two") + bytes(20)
    v2 = b"ID3\x03\0\0" + mpeg._syncsafe(len(body)) + body
    old = b"TT2" + (4).to_bytes(3, "big") + b"\0abc"
    v22 = b"ID3\x02\0\0" + mpeg._syncsafe(len(old)) + old
    v1 = b"TAG" + b"Title".ljust(30, b"\0") + b"Artist".ljust(30, b" ") + bytes(30) + b"1999" + bytes(29) + b"\x05" + b"\xff"
    item = lambda k, v: len(v).to_bytes(4, "little") + bytes(4) + k + b"\0" + v
    items = item(b"Mood", "blå".encode()) + item(b"Year", b"2001")
    ape = items + b"APETAGEX" + (2000).to_bytes(4, "little") + (len(items) + 32).to_bytes(4, "little") + (2).to_bytes(4, "little") + bytes(12)
    s = mpeg.parse(v2 + v22 + frame * 3 + ape + v1)
    assert s.tags == ["ID3v2.3", "ID3v2.2", "ID3v1", "APE"] and len(s.offsets) == 3 and s.junk == 0
    assert s.fields == {"TIT2": "Käse", "TPE1": "Ω x", "TALB": "café/two", "TT2": "abc", "title": "Title", "artist": "Artist", "year": "1999", "track": "5", "Mood": "blå", "Year": "2001"}


def test_seek_table_agrees_with_the_frames():
    _, data = stream(60)
    s = mpeg.parse(data)
    assert 0 <= s.toc_error <= s.vbr_bytes // 256 + max(s.sizes)
    wrong = bytearray(data)
    at = data.index(b"Xing") + 16
    wrong[at + 40] = 250
    assert mpeg.parse(bytes(wrong)).toc_error > s.vbr_bytes // 4
    assert mpeg.parse(b"").toc_error is None
