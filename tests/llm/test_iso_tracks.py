"""Containers of several tracks and of fragments."""

import struct

from tidewatch.llm import iso_media
from tidewatch.llm.iso_media import _box, _full


def trak(track_id, kind, codec, scale, delta, sizes, chunk, keys=None):
    n = len(sizes)
    stbl = [
        _full(b"stsd", struct.pack(">I", 1), _box(codec, bytes(16))),
        _full(b"stts", struct.pack(">I", int(n > 0)), *([struct.pack(">II", n, delta)] if n else [])),
        _full(b"stsc", struct.pack(">I", int(n > 0)), *([struct.pack(">III", 1, n, 1)] if n else [])),
        _full(b"stsz", struct.pack(">II", 0, n), *(struct.pack(">I", x) for x in sizes)),
        _full(b"stco", struct.pack(">I", int(n > 0)), *([struct.pack(">I", chunk)] if n else [])),
    ]
    if keys:
        stbl.append(_full(b"stss", struct.pack(">I", len(keys)), *(struct.pack(">I", k) for k in keys)))
    mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, scale, 0, 0, 0)), _full(b"hdlr", struct.pack(">I4s12x", 0, kind), b"\0"), _box(b"minf", _box(b"stbl", *stbl)))
    return _box(b"trak", _full(b"tkhd", struct.pack(">IIIII", 0, 0, track_id, 0, 0), bytes(60)), mdia)


def described(spark, data):
    return iso_media.describe(spark.createDataFrame([(data,)], "m binary"), "m").first()


def test_audio_first(spark):
    def build(at):
        return _box(b"moov", trak(1, b"soun", b"mp4a", 100, 50, [2, 3], at), trak(2, b"vide", b"avc1", 10, 1, [5, 6, 7, 8], at + 5, [1, 3]))

    at = len(build(0)) + 8
    r = described(spark, build(at) + _box(b"mdat", bytes(31)))
    assert r["media_error"] is None
    assert (r["media_codec"], r["media_seconds"], r["media_samples"], [tuple(x) for x in r["media_keyframes"]]) == ("avc1", 0.4, 4, [(at + 5, at + 9), (at + 16, at + 22)])
    audio, video = r["media_tracks"]
    assert (audio["track_id"], audio["kind"], audio["codec"], audio["seconds"], audio["samples"]) == (1, "soun", "mp4a", 1.0, 2)
    assert [tuple(x) for x in audio["keyframes"]] == [(at, at + 1), (at + 2, at + 4)]
    assert (video["track_id"], video["samples"], video["keyframes"]) == (2, 4, r["media_keyframes"])


def fragmented(track_id=2):
    mvex = _box(b"mvex", _full(b"trex", struct.pack(">IIIII", 1, 1, 4, 3, 0)), _full(b"trex", struct.pack(">IIIII", 2, 1, 1, 0, 0x10000)))
    head = _box(b"moov", trak(1, b"soun", b"mp4a", 8, 1, [], 0), trak(2, b"vide", b"avc1", 2, 1, [], 0), mvex)

    def moof(at):
        video = _box(
            b"traf",
            _full(b"tfhd", struct.pack(">I", track_id), flags=0x20000),
            _full(b"trun", struct.pack(">IiI", 3, at, 0), struct.pack(">III", 4, 5, 6), flags=0x205),
            _full(b"trun", struct.pack(">I", 1), struct.pack(">III", 9, 7, 0), flags=0x700),
        )
        audio = _box(b"traf", _full(b"tfhd", struct.pack(">I", 1)), _full(b"trun", struct.pack(">I", 2)))
        return _box(b"moof", video, audio)

    at = len(moof(0)) + 8
    return head + moof(at) + _box(b"mdat", bytes(28)), len(head) + at


def test_fragments(spark):
    data, at = fragmented()
    r = described(spark, data)
    assert r["media_error"] is None
    assert (r["media_codec"], r["media_seconds"], r["media_samples"]) == ("avc1", 6.0, 4)
    assert [tuple(x) for x in r["media_keyframes"]] == [(at, at + 3), (at + 15, at + 21)]
    audio = r["media_tracks"][0]
    assert (audio["seconds"], audio["samples"], [tuple(x) for x in audio["keyframes"]]) == (1.0, 2, [(at + 22, at + 24), (at + 25, at + 27)])
    assert described(spark, fragmented(9)[0])["media_error"] is not None
    assert described(spark, data[:-1])["media_error"] is not None
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 0xFF
        try:
            iso_media.tracks(memoryview(bytes(bad)))
        except iso_media.MediaError:
            pass
