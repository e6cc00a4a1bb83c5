"""Hand-made frames and capture files."""

from __future__ import annotations

import struct
from pathlib import Path


def ip_bytes(text: str) -> bytes:
    return bytes(int(part) for part in text.split("."))


def tcp_segment(sport, dport, payload=b"", flags=0x18, seq=1, ack=1, window=500, options=b""):
    words = 5 + len(options) // 4
    return struct.pack(">HHIIBBHHH", sport, dport, seq, ack, words << 4, flags, window, 0, 0) + options + payload


def udp_datagram(sport, dport, payload=b""):
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def ipv4(src, dst, body, proto=6, ttl=64, tos=0, flags=0x4000, options=b""):
    words = 5 + len(options) // 4
    head = struct.pack(">BBHHHBBH", 0x40 | words, tos, 4 * words + len(body), 1, flags, ttl, proto, 0)
    return head + ip_bytes(src) + ip_bytes(dst) + options + body


def ipv6(src: bytes, dst: bytes, body, proto=6):
    return struct.pack(">IHBB", 6 << 28, len(body), proto, 64) + src + dst + body


def ethernet(packet, ethertype=0x0800, tags=(), pad_to=0):
    frame = b"\x02" * 12
    for kind, tag in tags:
        frame += struct.pack(">HH", kind, tag)
    frame += struct.pack(">H", ethertype) + packet
    return frame + b"\0" * max(0, pad_to - len(frame))


def capture(packets, order="<", nanos=False, link=1, cut=0) -> bytes:
    """``packets``: (ts_us, frame) pairs; ``cut`` bytes are missing at the end."""
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    out = struct.pack(order + "IHHIIII", magic, 2, 4, 0, 0, 262144, link)
    for ts_us, frame in packets:
        fraction = ts_us % 1_000_000 * (1000 if nanos else 1)
        out += struct.pack(order + "IIII", ts_us // 1_000_000, fraction, len(frame), len(frame)) + frame
    return out[: len(out) - cut] if cut else out


def write(path: Path, content: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
