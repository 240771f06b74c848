"""Media columns from ISO base media containers.

``describe`` walks the nested boxes of each container, decodes the sample tables
(stts, stss, stsc, stsz, stco or co64) of each track and its fragments' runs (tfhd, trun, with the
defaults of trex), and stores codec, duration and the byte ranges of the keyframes of every track in
``media_tracks``, and in columns of their own those of the main one: the first video track, or else
the first track. Payload bytes are never decoded. ``mux`` writes bytes losslessly as a track of
uncompressed 8-bit frames, and ``samples`` reads a track's bytes back by its tables.

Cases: null or empty bytes, and bytes that aren't a container or whose tables disagree, give
null columns and ``media_error``; repeated rows each get the same result; an empty table gives
an empty result; an input column with the name of a result is replaced.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.common import DOUBLE, LONG, STRING, with_columns

#: A frame of 16 x 12 gray pixels.
WIDTH, HEIGHT = 16, 12
FRAME = WIDTH * HEIGHT
#: Frames for each second, chunk and keyframe.
RATE, PER_CHUNK, PER_KEY = 25, 10, 12
#: Boxes that hold boxes only.
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"udta", b"mvex", b"moof", b"traf"}
RANGES = (
    T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])),
    pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])),
)


class MediaError(ValueError):
    """The bytes aren't a container that can be read."""


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


def mux(payload: bytes) -> bytes:
    """A container with ``payload`` (a positive multiple of ``FRAME`` bytes) as 8-bit gray frames."""
    if not payload or len(payload) % FRAME:
        raise ValueError("the payload has to be a positive multiple of a frame")
    n = len(payload) // FRAME
    chunks, rest = divmod(n, PER_CHUNK)
    runs = ([(1, PER_CHUNK)] if chunks else []) + ([(chunks + 1, rest)] if rest else [])
    keys = np.arange(1, n + 1, PER_KEY, dtype=">u4")
    entry = struct.pack(">6xH16xHHIIIH32sHh", 1, WIDTH, HEIGHT, 72 << 16, 72 << 16, 0, 1, b"", 8, -1)
    wide = len(payload) + (1 << 20) + 8 * n >= 1 << 32

    def head(at: int) -> bytes:
        starts = at + np.arange(chunks + bool(rest), dtype=np.int64) * (PER_CHUNK * FRAME)
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), _box(b"raw ", entry)),
            _full(b"stts", struct.pack(">III", 1, n, 1)),
            _full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", first, per, 1) for first, per in runs)),
            _full(b"stsz", struct.pack(">II", FRAME, n)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", len(starts)), starts.astype(">u8" if wide else ">u4").tobytes()),
        )
        matrix = struct.pack(">9i", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)
        return _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2") + _box(
            b"moov",
            _full(b"mvhd", struct.pack(">IIII", 0, 0, RATE, n), struct.pack(">IH10x", 1 << 16, 1 << 8), matrix, bytes(24), struct.pack(">I", 2)),
            _box(
                b"trak",
                _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(8), struct.pack(">hhhH", 0, 0, 0, 0), matrix, struct.pack(">II", WIDTH << 16, HEIGHT << 16), flags=3),
                _box(
                    b"mdia",
                    _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, n, 0x55C4, 0)),
                    _full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"frames\0"),
                    _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl),
                ),
            ),
        )

    size = len(head(0)) + (16 if len(payload) + 8 >= 1 << 32 else 8)
    return head(size) + _box(b"mdat", payload)


def walk(data: memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, start and end of the body) of every box, parents before their children."""
    end = len(data) if end is None else end
    at = start
    while at < end:
        if at + 8 > end:
            raise MediaError("a box is cut short")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if at + 16 > end:
                raise MediaError("a box is cut short")
            size, body = struct.unpack_from(">Q", data, body)[0], at + 16
        stop = end if size == 0 else at + size
        if stop < body or stop > end:
            raise MediaError("a box exceeds its parent")
        here = (*path, kind)
        yield here, body, stop
        if kind in NESTED:
            yield from walk(data, body, stop, here)
        at = stop


def _table(data: memoryview, span: tuple[int, int], kind: str, width: int = 1, skip: int = 4) -> np.ndarray:
    """The rows of a table box: a count, then rows of ``width`` big-endian numbers."""
    start, end = span
    if start + skip + 4 > end:
        raise MediaError("a table is cut short")
    n = struct.unpack_from(">I", data, start + skip)[0]
    at, size = start + skip + 4, n * width * np.dtype(kind).itemsize
    if at + size > end:
        raise MediaError("a table is cut short")
    return np.frombuffer(data, kind, n * width, at).astype(np.int64).reshape(n, width)


def _sample_tables(data: memoryview, found: dict[bytes, tuple[int, int]]) -> dict:
    """A track by the boxes of its trak: id, kind, codec, timescale, duration, and offset, size and key flag of its samples."""
    missing = [k for k in (b"mdhd", b"stsd", b"stts", b"stsc", b"stsz") if k not in found]
    if missing or not found.keys() & {b"stco", b"co64"}:
        raise MediaError("a track has no sample tables")
    start, _ = found[b"mdhd"]
    timescale = struct.unpack_from(">I", data, start + (20 if data[start] else 12))[0]
    codec = bytes(data[found[b"stsd"][0] + 12 : found[b"stsd"][0] + 16]).decode("latin-1")
    size, n = struct.unpack_from(">II", data, found[b"stsz"][0] + 4)
    at = found.get(b"tkhd", (None,))[0]
    track_id = 0 if at is None else struct.unpack_from(">I", data, at + (20 if data[at] else 12))[0]
    kind = bytes(data[found[b"hdlr"][0] + 8 : found[b"hdlr"][0] + 12]).decode("latin-1") if b"hdlr" in found else ""
    if n > len(data):
        raise MediaError("the tables disagree with the samples")
    sizes = np.full(n, size, np.int64) if size else _table(data, found[b"stsz"], ">u4", skip=8)[:, 0]
    chunks = _table(data, found[b"co64"], ">u8")[:, 0] if b"co64" in found else _table(data, found[b"stco"], ">u4")[:, 0]
    runs = _table(data, found[b"stsc"], ">u4", 3)
    per = np.zeros(len(chunks), np.int64)
    for first, samples, _ in runs.tolist():
        per[max(0, first - 1) :] = samples
    if per.sum() != n:
        raise MediaError("the chunks don't hold the samples")
    before = np.concatenate([[0], np.cumsum(sizes)])
    first = np.repeat(np.cumsum(per) - per, per)
    offsets = np.repeat(chunks, per) + before[:-1] - before[first]
    times = _table(data, found[b"stts"], ">u4", 2)
    if times[:, 0].sum() != n or not timescale or n and (offsets + sizes).max() > len(data):
        raise MediaError("the tables disagree with the samples")
    keys = _table(data, found[b"stss"], ">u4")[:, 0] - 1 if b"stss" in found else np.arange(n)
    if len(keys) and not 0 <= keys.min() <= keys.max() < n:
        raise MediaError("a keyframe isn't among the samples")
    return {"id": track_id, "kind": kind, "codec": codec, "timescale": timescale, "duration": int((times[:, 0] * times[:, 1]).sum()), "offsets": offsets, "sizes": sizes, "keys": keys}


def _optional(data: memoryview, at: int, end: int, flags: int, fields: tuple[tuple[int, str, str], ...]) -> tuple[dict, int]:
    """The fields (flag, name, format) that the flags of a box say are there, and where they end."""
    got = {}
    for flag, name, kind in fields:
        if flags & flag:
            if at + struct.calcsize(kind) > end:
                raise MediaError("a header is cut short")
            got[name] = struct.unpack_from(kind, data, at)[0]
            at += struct.calcsize(kind)
    return got, at


HEADER = ((1, "base", ">Q"), (2, "description", ">I"), (8, "duration", ">I"), (16, "size", ">I"), (32, "flags", ">I"))
RUN = ((1, "offset", ">i"), (4, "first", ">I"))
#: The flag of a sample that isn't a keyframe.
NOT_KEY = 0x10000


def _add_fragment(data: memoryview, moof: int, trafs: list[list[tuple[bytes, int, int]]], tracks: dict[int, dict], defaults: dict[int, dict]) -> None:
    """Append the runs of a fragment, whose box begins at ``moof``, to its tracks."""
    last = moof
    for boxes in trafs:
        head = next(((start, end) for kind, start, end in boxes if kind == b"tfhd"), None)
        if head is None:
            raise MediaError("a track fragment has no header")
        flags, track_id = struct.unpack_from(">II", data, head[0])
        found = tracks.get(track_id)
        if found is None:
            raise MediaError("a fragment is of no track")
        given, _ = _optional(data, head[0] + 8, head[1], flags, HEADER)
        base = given.get("base", moof if flags & 0x20000 else last)
        use = {"duration": 0, "size": 0, "flags": 0} | defaults.get(track_id, {}) | given
        last = base
        for _, start, end in (b for b in boxes if b[0] == b"trun"):
            flags, n = struct.unpack_from(">II", data, start)
            flags &= 0xFFFFFF
            run, at = _optional(data, start + 8, end, flags, RUN)
            named = [name for flag, name in ((0x100, "duration"), (0x200, "size"), (0x400, "flags"), (0x800, "shift")) if flags & flag]
            if n > len(data) or at + 4 * n * len(named) > end:
                raise MediaError("a run is cut short")
            rows = np.frombuffer(data, ">u4", n * len(named), at).astype(np.int64).reshape(n, len(named)) if named else np.zeros((n, 0), np.int64)
            column = lambda name, rows=rows, named=named, n=n: rows[:, named.index(name)] if name in named else np.full(n, use[name], np.int64)  # noqa: B023, E731
            sizes, marks = column("size"), column("flags").copy()
            if "first" in run and n:
                marks[0] = run["first"]
            begin = base + run["offset"] if "offset" in run else last
            offsets = begin + np.cumsum(sizes) - sizes
            last = int(begin + sizes.sum())
            if begin < 0 or last > len(data):
                raise MediaError("a run exceeds the file")
            keys = np.flatnonzero(marks & NOT_KEY == 0) + sum(map(len, found["parts"]["sizes"]))
            found["duration"] += int(column("duration").sum())
            for name, values in (("offsets", offsets), ("sizes", sizes), ("keys", keys)):
                found["parts"][name].append(values)


def tracks(data: memoryview) -> list[dict]:
    """Every track, in order, each by its own tables and the runs of its fragments."""
    traks: list[dict[bytes, tuple[int, int]]] = []
    defaults: dict[int, dict] = {}
    fragments: list[tuple[int, list[list[tuple[bytes, int, int]]]]] = []
    try:
        for path, start, end in walk(data):
            if path == (b"moov", b"trak"):
                traks.append({})
            elif path[:2] == (b"moov", b"trak"):
                traks[-1].setdefault(path[-1], (start, end))
            elif path == (b"moov", b"mvex", b"trex"):
                track_id, _, *values = struct.unpack_from(">IIIII", data, start + 4)
                defaults[track_id] = dict(zip(("duration", "size", "flags"), values, strict=True))
            elif path == (b"moof",):
                wide = start >= 16 and struct.unpack_from(">I4s", data, start - 16) == (1, b"moof")
                fragments.append((start - (16 if wide else 8), []))
            elif path == (b"moof", b"traf"):
                fragments[-1][1].append([])
            elif path[:2] == (b"moof", b"traf"):
                fragments[-1][1][-1].append((path[-1], start, end))
        if not traks:
            raise MediaError("no track with sample tables")
        made = [_sample_tables(data, x) for x in traks]
        by_id = {x["id"]: x for x in reversed(made)}
        for x in made:
            x["parts"] = {name: [x[name]] for name in ("offsets", "sizes", "keys")}
        for moof, trafs in fragments:
            _add_fragment(data, moof, trafs, by_id, defaults)
        for x in made:
            x |= {name: np.concatenate(parts) for name, parts in x.pop("parts").items()}
    except (struct.error, IndexError) as error:
        raise MediaError("a header is cut short") from error
    return made


def main_track(found: list[dict]) -> dict:
    """The first video track, or else the first track."""
    return next((x for x in found if x["kind"] == "vide"), found[0])


def track(data: memoryview) -> dict:
    """The main track of a container."""
    return main_track(tracks(data))


def samples(data: bytes, found: dict) -> bytes:
    """The stored bytes of a track's samples, in order; neighbours are read at once."""
    starts, sizes = found["offsets"], found["sizes"]
    if not len(starts):
        return b""
    breaks = np.flatnonzero(starts[1:] != starts[:-1] + sizes[:-1]) + 1
    first = np.concatenate([[0], breaks])
    last = np.concatenate([breaks, [len(starts)]]) - 1
    view = memoryview(data)
    return b"".join(view[a:b] for a, b in zip(starts[first].tolist(), (starts[last] + sizes[last]).tolist(), strict=True))


def key_ranges(found: dict) -> list[tuple[int, int]]:
    """First and last byte of every keyframe."""
    at, size = found["offsets"][found["keys"]], found["sizes"][found["keys"]]
    return list(zip(at.tolist(), (at + size - 1).tolist(), strict=True))


TRACKS = (
    T.ArrayType(T.StructType([T.StructField("track_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("codec", T.StringType()), T.StructField("seconds", T.DoubleType()), T.StructField("samples", T.LongType()), T.StructField("keyframes", RANGES[0])])),
    pa.list_(pa.struct([("track_id", pa.int64()), ("kind", pa.string()), ("codec", pa.string()), ("seconds", pa.float64()), ("samples", pa.int64()), ("keyframes", RANGES[1])])),
)
COLUMNS = {"media_codec": STRING, "media_seconds": DOUBLE, "media_samples": LONG, "media_keyframes": RANGES, "media_tracks": TRACKS, "media_error": STRING}


def _shown(found: dict) -> dict:
    ranges = [{"first": a, "last": b} for a, b in key_ranges(found)]
    return {"track_id": found["id"], "kind": found["kind"], "codec": found["codec"], "seconds": found["duration"] / found["timescale"], "samples": len(found["sizes"]), "keyframes": ranges}


def described(data: bytes | None) -> tuple:
    """The values of ``COLUMNS`` for one container."""
    try:
        found = tracks(memoryview(data or b""))
    except MediaError as error:
        return None, None, None, None, None, str(error)
    every = [_shown(x) for x in found]
    best = next(x for x, y in zip(every, found, strict=True) if y is main_track(found))
    return best["codec"], best["seconds"], best["samples"], best["keyframes"], every, None


def _for_each(one, width: int):
    """What ``with_columns`` starts: ``one`` gives a tuple of ``width`` values for each value."""
    return lambda: lambda values: list(map(list, zip(*map(one, values), strict=True))) if values else [[] for _ in range(width)]


def describe(df: DataFrame, bytes_col: str) -> DataFrame:
    """``df`` with codec, seconds, samples and keyframe byte ranges of a column of containers: those of the main track and, in ``media_tracks``, of all."""
    return with_columns(df, bytes_col, COLUMNS, _for_each(described, len(COLUMNS)), kind="binary")


def text_payload(text: str | None) -> tuple[int, bytes]:
    """The UTF-8 bytes' number, and the bytes padded with spaces to a positive multiple of a frame."""
    raw = (text or "").encode()
    return len(raw), raw + b" " * (-len(raw) % FRAME or (0 if raw else FRAME))


def stored_texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every text stored as a container (``media``) and ``n_bytes`` before padding."""

    def start():
        def apply(texts: list) -> list:
            made = [text_payload(t) for t in texts]
            return [[n for n, _ in made], [mux(p) for _, p in made]]

        return apply

    return with_columns(df, text_col, {"n_bytes": LONG, "media": (T.BinaryType(), pa.binary())}, start)


DIGESTS = {"payload_bytes": LONG, "payload_sha256": STRING, "tail_crc32": LONG, "media_bytes": LONG, "media_sha256": STRING, "feature": STRING}


def digested(data: bytes) -> tuple:
    """The values of ``DIGESTS`` for one container."""
    found = track(memoryview(data))
    payload, ranges = samples(data, found), key_ranges(found)
    crc = zlib.crc32(np.array(ranges, "<i8").tobytes())
    feature = f"{found['codec'].strip()} {found['duration'] / found['timescale']:.2f}s {len(found['sizes'])} samples {len(ranges)} keyframes {ranges[0][0]}-{ranges[-1][1]} {crc:08x}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature


def digests(df: DataFrame, bytes_col: str = "media") -> DataFrame:
    """``df`` with digests of the stored form and of the samples read back, and a feature string."""
    return with_columns(df, bytes_col, DIGESTS, _for_each(digested, len(DIGESTS)), kind="binary")


def text_digests(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with what ``stored_texts``, ``describe`` and ``digests`` say of every text's container, which stays in the task that wrote it."""

    def one(text: str | None) -> tuple:
        n, payload = text_payload(text)
        data = mux(payload)
        return n, *described(data), *digested(data)

    new = {"n_bytes": LONG, **COLUMNS, **DIGESTS}
    return with_columns(df, text_col, new, _for_each(one, len(new)))
