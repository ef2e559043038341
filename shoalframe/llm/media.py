"""MPEG audio columns: a parser for whole streams, and a lossless carrier of bytes in Layer III frames.

parse() accepts any byte string. It skips an ID3v2 tag, looks for frame headers, accepts one only if another
header of the same kind (or the end of the audio) follows where its length says, and resynchronises byte by
byte otherwise; it reads Xing/Info and VBRI tables, verifies the CRC-16 of protected Layer III frames, and
gives the exact duration as samples and sample rate with the byte offset of every audio frame.

The carrier puts a payload into the main data of such frames: 48 kHz, protected, bit rates chosen so that the
last frame is as short as the rest allows (hence variable bit rate, with a Xing frame and its seek table).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import long_rows

# Fixed values of the format: kbit/s by (version 1 or not, layer), sample rates by version, side information bytes.
_KBPS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_KBPS[2, 3] = _KBPS[2, 2]
_RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 8
        for _ in range(8):
            c = (c << 1 ^ 0x8005) & 0xFFFF if c & 0x8000 else c << 1
        out.append(c)
    return out


_TABLE = _crc_table()


@lru_cache(4096)
def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, initially all ones."""
    c = 0xFFFF
    for b in data:
        c = (c << 8 & 0xFF00) ^ _TABLE[c >> 8 ^ b]
    return c


@lru_cache(4096)
def header(word: bytes) -> dict | None:
    """What four bytes say as a frame header, or None."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    rate, kbps, pad = word[2] >> 2 & 3, word[2] >> 4, word[2] >> 1 & 1
    if version == 1 or layer == 4 or rate == 3 or kbps in (0, 15):
        return None
    one = version == 3
    hz, bits = _RATES[version][rate], _KBPS[1 if one else 2, layer][kbps] * 1000
    if layer == 1:
        size, samples = (12 * bits // hz + pad) * 4, 384
    else:
        samples = 1152 if one or layer == 2 else 576
        size = samples // 8 * bits // hz + pad
    mono = word[3] >> 6 == 3
    side = 0 if layer != 3 else (17 if mono else 32) if one else (9 if mono else 17)
    return {"size": size, "samples": samples, "hz": hz, "kbps": bits // 1000, "layer": layer, "version": version, "side": side, "crc": not word[1] & 1, "kind": (version, layer, rate)}


def _synchsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def _tags(data: bytes) -> tuple[int, int, dict[str, str]]:
    """Where the audio begins and ends, and the text frames of the tags."""
    start, end, tags = 0, len(data), {}
    if data[:3] == b"ID3" and len(data) >= 10 and max(data[6:10]) < 128:
        start = min(end, 10 + _synchsafe(data[6:10]) + (10 if data[5] & 0x10 else 0))
        at, stop = 10, min(end, 10 + _synchsafe(data[6:10]))
        while data[3] >= 3 and at + 10 <= stop and data[at : at + 4].strip(b"\0"):
            n = _synchsafe(data[at + 4 : at + 8]) if data[3] == 4 else int.from_bytes(data[at + 4 : at + 8], "big")
            body = data[at + 10 : at + 10 + n]
            name = data[at : at + 4].decode("latin-1")
            if name.startswith("T") and body:
                text = body[1:].decode({0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1"), "replace")
                key, _, value = text.partition("\0") if name == "TXXX" else (name, "", text)
                tags[key] = value.rstrip("\0")
            at += 10 + n
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        tags.setdefault("TIT2", data[end + 3 : end + 33].split(b"\0")[0].decode("latin-1"))
    return start, end, tags


def _table(data: bytes, at: int, h: dict) -> dict | None:
    """The variable-bitrate table in a first frame, if it is one."""
    xing = at + 4 + 2 * h["crc"] + h["side"]
    if data[xing : xing + 4] in (b"Xing", b"Info"):
        flags, p = int.from_bytes(data[xing + 4 : xing + 8], "big"), xing + 8
        out: dict = {"table": data[xing : xing + 4].decode(), "toc": []}
        for bit, key in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[key], p = int.from_bytes(data[p : p + 4], "big"), p + 4
        if flags & 4:
            out["toc"] = list(data[p : p + 100])
        return out
    vbri = at + 36
    if data[vbri : vbri + 4] == b"VBRI" and len(data) >= vbri + 26:
        _, _, _, size, frames, n, scale, width, _ = struct.unpack(">HHHIIHHHH", data[vbri + 4 : vbri + 26])
        p = vbri + 26
        toc = [int.from_bytes(data[p + i * width : p + (i + 1) * width], "big") * scale for i in range(n)]
        return {"table": "VBRI", "frames": frames, "bytes": size, "toc": toc}
    return None


def parse(data: bytes) -> dict:
    """Frames, tags, tables and checksums of a stream; an empty or foreign stream has no frames and duration 0."""
    at, end, tags = _tags(data)
    out = {"tags": tags, "offsets": [], "headers": [], "samples": 0, "hz": 0, "skipped": 0, "bad_crc": 0, "checked": 0, "vbr": None, "end": end}
    kind, locked = None, False
    while at + 4 <= end:
        h = header(data[at : at + 4])
        if h and (kind is None or h["kind"] == kind) and at + h["size"] <= end:
            after = at + h["size"]
            follows = after + 4 <= end and (n := header(data[after : after + 4])) and n["kind"] == h["kind"]
            if follows or after + 4 > end or locked:
                if h["crc"] and h["layer"] == 3:
                    body = at + 6
                    out["checked"] += 1
                    out["bad_crc"] += crc16(data[at + 2 : at + 4] + data[body : body + h["side"]]) != int.from_bytes(data[at + 4 : at + 6], "big")
                if kind is None:
                    kind = h["kind"]
                    out["vbr"] = _table(data, at, h)
                if not (out["vbr"] and not out["headers"] and "first" not in out["vbr"]):
                    out["offsets"].append(at)
                    out["headers"].append(h)
                    out["samples"] += h["samples"]
                else:
                    out["vbr"]["first"] = at
                out["hz"], locked, at = h["hz"], bool(follows), after
                continue
        nxt = data.find(b"\xff", at + 1, end)
        nxt = end if nxt < 0 else nxt
        out["skipped"] += nxt - at
        at, locked = nxt, False
    return out


# ---------------------------------------------------------------- the carrier
_SIDE = bytes(32)
_ROOM = {kbps: 3 * kbps - 38 for kbps in _KBPS[1, 3][1:]}  # main data of a protected 48 kHz stereo frame


@lru_cache(64)
def _head(kbps: int) -> bytes:
    word = bytes([0xFF, 0xFA, _KBPS[1, 3].index(kbps) << 4 | 1 << 2, 0])
    return word + crc16(word[2:] + _SIDE).to_bytes(2, "big") + _SIDE


def _tag(n: int) -> bytes:
    body = b"\3payload_bytes\0" + b"%d" % n
    frame = b"TXXX" + len(body).to_bytes(4, "big") + b"\0\0" + body
    return b"ID3\3\0\0" + bytes([len(frame) >> 21 & 127, len(frame) >> 14 & 127, len(frame) >> 7 & 127, len(frame) & 127]) + frame


def store(payload: bytes) -> bytes:
    """A stream whose frames carry the payload in their main data."""
    room = _ROOM[320]
    n, rest = divmod(len(payload), room)
    full = np.empty((n, 960), np.uint8)
    full[:, :38] = np.frombuffer(_head(320), np.uint8)
    full[:, 38:] = np.frombuffer(payload, np.uint8, n * room).reshape(n, room)
    sizes, body = [960] * n, [full.tobytes()]
    if rest:
        kbps = next(k for k, r in _ROOM.items() if r >= rest)
        body.append(_head(kbps) + payload[n * room :] + bytes(_ROOM[kbps] - rest))
        sizes.append(3 * kbps)
    kbps = 128  # 384 bytes: a header, its side information, and the table
    audio = sum(sizes) + 3 * kbps
    starts = np.cumsum([3 * kbps, *sizes])[:-1] if sizes else np.zeros(1, np.int64)
    seek = starts[np.arange(100) * len(starts) // 100] * 256 // audio
    table = b"Xing" + (7).to_bytes(4, "big") + len(sizes).to_bytes(4, "big") + audio.to_bytes(4, "big") + seek.astype(np.uint8).tobytes()
    return b"".join([_tag(len(payload)), _head(kbps), table, bytes(_ROOM[kbps] - len(table)), *body])


def load(data: bytes, parsed: dict | None = None) -> bytes:
    """The payload of a stream made by store(), read from its frames."""
    p = parsed or parse(data)
    view = memoryview(data)
    n = int(p["tags"]["payload_bytes"])
    return b"".join(view[o + 38 : o + h["size"]] for o, h in zip(p["offsets"], p["headers"], strict=True))[:n]


def pad(text: str | None, unit: int = 64) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + bytes(max(unit, -(-len(raw) // unit) * unit) - len(raw))


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, n_samples long, sample_rate int, seconds double, frame_offsets array<long>"
)


def audio(docs: DataFrame) -> DataFrame:
    """Stores each whole text (null: empty) as MPEG audio, reads it back, and describes what was stored.

    Each row is handled by itself: repeated rows and equal texts give equal values, a null doc_id stays null, an
    empty text is 64 zero bytes in one frame, an empty table gives no rows, other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text in zip(batch["doc_id"], batch["text"], strict=True):
                n, payload = pad(text)
                media = store(payload)
                p = parse(media)
                back = load(media, p)
                heads = p["headers"]
                kbps = [h["kbps"] for h in heads]
                toc = zlib.crc32(bytes(p["vbr"]["toc"]))
                feature = f"mpeg1-l3;frames={len(heads)};samples={p['samples']};hz={p['hz']};kbps={min(kbps)}-{max(kbps)};table={p['vbr']['table']}:{p['vbr']['frames']};toc={toc:08x};crc_ok={p['checked'] - p['bad_crc']}/{p['checked']};skipped={p['skipped']}"
                rows.append(
                    (i, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature, p["samples"], p["hz"], p["samples"] / p["hz"], p["offsets"])
                )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})

    return long_rows(docs).select(F.col("doc_id").cast("long"), "text").mapInPandas(run, SCHEMA)
