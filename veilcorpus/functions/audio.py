"""Lengths of audio from the heads of its containers; nothing is decoded.

WAV (RIFF) and FLAC say in their first bytes how long they are. Every other input gets a status: `empty`,
`unknown format`, or `broken header`.
"""

from __future__ import annotations

import io
import struct
from typing import BinaryIO

LENGTH = "seconds double, status string"


def _wav_seconds(f: BinaryIO) -> float:
    rate = None
    while True:
        head = f.read(8)
        if len(head) < 8:
            raise ValueError("no data")
        name, size = struct.unpack("<4sI", head)
        if name == b"data":
            if not rate:
                raise ValueError("no format")
            return size / rate
        body = f.read(12) if name == b"fmt " else b""
        if name == b"fmt ":
            rate = struct.unpack("<I", body[8:12])[0]
        f.seek(size + size % 2 - len(body), io.SEEK_CUR)


def _flac_seconds(f: BinaryIO) -> float:
    head = f.read(4 + 34)
    if len(head) < 38 or head[0] & 0x7F:
        raise ValueError("no stream info")
    packed = int.from_bytes(head[14:22], "big")  # rate 20 bits, channels 3, depth 5, samples 36
    rate, samples = packed >> 44, packed & ((1 << 36) - 1)
    if not rate or not samples:
        raise ValueError("no rate or length")
    return samples / rate


def header_length(f: BinaryIO) -> tuple[float | None, str]:
    """Seconds and status of an open file."""
    start = f.read(4)
    try:
        if not start:
            return None, "empty"
        if start == b"fLaC":
            return _flac_seconds(f), "ok"
        if start == b"RIFF":
            if f.read(8)[4:] != b"WAVE":
                return None, "unknown format"
            return _wav_seconds(f), "ok"
    except (ValueError, struct.error):
        return None, "broken header"
    return None, "unknown format"
