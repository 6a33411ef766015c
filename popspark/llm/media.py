"""Media columns: texts as private data in MPEG transport streams.

The encoder writes a program association table, a program map and elementary packets with time stamps into 188-byte
transport packets; the decoder parses the tables, checks continuity counters, reassembles the elementary packets, and
gives time stamps and random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import durable, slices, texts_of

#: Fixed values of the format.
PACKET, SYNC, PAT_PID, MAP_PID, DATA_PID, PRIVATE_STREAM, PRIVATE_TYPE, CLOCK = 188, 0x47, 0x0000, 0x1000, 0x0100, 0xBD, 0x06, 90_000
FRAME = 576
FRAMES = 8  # in an elementary packet
TICKS = FRAMES * CLOCK * 24 // 1000  # a frame lasts 24 ms


def pad(text: bytes, unit: int = FRAME) -> bytes:
    """The text and bytes 255 up to a positive multiple of unit."""
    return text.ljust(max(unit, -(-len(text) // unit) * unit), b"\xff")


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def section(table: int, number: int, body: bytes) -> bytes:
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\0\0"
    return (out := head + body) + section_crc(out).to_bytes(4, "big")


def packet(pid: int, counter: int, payload: bytes, start: bool, clock: int | None = None) -> bytes:
    """One transport packet; room that payload leaves becomes stuffing of the adaptation field."""
    field_ = b""
    if clock is not None:
        field_ = b"\x50" + (clock << 15 | 0x7E00).to_bytes(6, "big")  # random access, clock reference
    room = PACKET - 4 - len(payload)
    if room:
        if room > 1:
            field_ = (field_ or b"\0").ljust(room - 1, b"\xff")
        field_ = bytes([room - 1]) + field_
    return bytes([SYNC, start << 6 | pid >> 8, pid & 255, (0x30 if room else 0x10) | counter & 15]) + field_ + payload


_TABLES = b"".join(
    packet(pid, 0, (b"\0" + body).ljust(PACKET - 4, b"\xff"), True)
    for pid, body in (
        (PAT_PID, section(0, 1, (1).to_bytes(2, "big") + (0xE000 | MAP_PID).to_bytes(2, "big"))),
        (MAP_PID, section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0" + bytes([PRIVATE_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\0")),
    )
)


def _stamp(ticks: int) -> bytes:
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 255, ticks >> 14 & 254 | 1, ticks >> 7 & 255, ticks << 1 & 254 | 1])


def _unstamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1


def mux(payload: bytes) -> bytes:
    """payload, a multiple of FRAME bytes, as a transport stream."""
    out, counter, unit = [_TABLES], 0, FRAME * FRAMES
    for n, at in enumerate(range(0, len(payload), unit)):
        data = payload[at : at + unit]
        ticks = n * TICKS & (1 << 33) - 1
        pes = b"\0\0\x01" + bytes([PRIVATE_STREAM]) + (len(data) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(ticks) + data
        first = PACKET - 4 - 8
        out.append(packet(DATA_PID, counter, pes[:first], True, ticks))
        counter += 1
        for i in range(first, len(pes), PACKET - 4):
            out.append(packet(DATA_PID, counter, pes[i : i + PACKET - 4], False))
            counter += 1
    return b"".join(out)


@dataclass
class Elementary:
    """One elementary stream: its type, and of each packet the payload, the time stamp (or None) and whether random access starts there."""

    kind: int
    payloads: list[bytes] = field(default_factory=list)
    stamps: list[int | None] = field(default_factory=list)
    access: list[bool] = field(default_factory=list)


@dataclass
class Stream:
    programs: dict[int, int] = field(default_factory=dict)  # program -> pid of its map
    streams: dict[int, Elementary] = field(default_factory=dict)  # by pid
    access: list[int] = field(default_factory=list)  # packet numbers of random-access points
    gaps: int = 0  # breaks of the continuity counters, and packets marked as damaged
    orphans: int = 0  # elementary packets that continue what wasn't seen to begin

    @property
    def payload(self) -> bytes:
        return b"".join(b"".join(e.payloads) for e in self.streams.values())


#: Stream ids whose packets have no header beyond the length.
_BARE = {0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF}


def _pes(data: bytes) -> tuple[bytes, int | None]:
    """Payload and time stamp of an elementary packet; a length of 0 means up to its end."""
    if data[:3] != b"\0\0\x01" or len(data) < 6:
        raise ValueError("an elementary packet has no start code")
    length = int.from_bytes(data[4:6], "big")
    end = 6 + length if length else len(data)
    if data[3] in _BARE or len(data) < 9:
        return data[6:end], None
    return data[9 + data[8] : end], _unstamp(data[9:14]) if data[7] & 0x80 else None


class _Sections:
    """Sections of one pid, put together from the packets that hold them."""

    def __init__(self):
        self.data, self.begun = b"", False

    def add(self, payload: bytes, start: bool) -> list[bytes]:
        out = []
        if start:
            before = 1 + payload[0]
            if self.begun:
                self.data += payload[1:before]
                out += self._whole()
            self.data, self.begun = payload[before:], True
        elif self.begun:
            self.data += payload
        return out + self._whole()

    def _whole(self) -> list[bytes]:
        out = []
        while len(self.data) >= 3 and self.data[0] != 0xFF:
            size = 3 + (int.from_bytes(self.data[1:3], "big") & 0x0FFF)
            if len(self.data) < size:
                break
            section_, self.data = self.data[:size], self.data[size:]
            if section_crc(section_):
                raise ValueError("a table's checksum is wrong")
            if section_[5] & 1:  # in force, not the next one
                out.append(section_)
        return out


def _map_entries(section_: bytes):
    """(pid, stream type) of each elementary stream of a program map."""
    at = 12 + (int.from_bytes(section_[10:12], "big") & 0x0FFF)
    while at < len(section_) - 4:
        yield int.from_bytes(section_[at + 1 : at + 3], "big") & 0x1FFF, section_[at]
        at += 5 + (int.from_bytes(section_[at + 3 : at + 5], "big") & 0x0FFF)


def demux(stream: bytes) -> Stream:
    """Parse a transport stream and reassemble the packets of each of its elementary streams.

    Packets of other pids than those of the tables are passed over.  A packet repeated with its counter counts once.  After
    a break of a counter the packets that came stay; what continues an unseen beginning is left out.
    """
    out, last, sections, maps = Stream(), {}, {PAT_PID: _Sections()}, set()
    open_: dict[int, list[bytes]] = {}

    def close(pid: int) -> None:
        payload, stamp = _pes(b"".join(open_.pop(pid)))
        out.streams[pid].payloads.append(payload)
        out.streams[pid].stamps.append(stamp)

    for number, at in enumerate(range(0, len(stream), PACKET)):
        if stream[at] != SYNC or at + PACKET > len(stream):
            raise ValueError(f"packet {number} has no sync byte or is cut short")
        a, b, flags = stream[at + 1], stream[at + 2], stream[at + 3]
        pid = (a & 31) << 8 | b
        body, adaptation = at + 4, 0
        if flags & 0x20:
            adaptation = stream[body + 1] if stream[body] else 0
            body += 1 + stream[body]
        if adaptation & 0x40:
            out.access.append(number)
        if a & 0x80:
            out.gaps += 1
            continue
        if not flags & 0x10 or pid == 0x1FFF:
            continue
        data, start = stream[body : at + PACKET], bool(a & 0x40)
        before = last.get(pid)
        if before is not None and not adaptation & 0x80:
            if flags & 15 == before[0] and data == before[1]:
                continue
            out.gaps += flags & 15 != before[0] + 1 & 15
        last[pid] = flags & 15, data
        if pid in out.streams:
            if start:
                if pid in open_:
                    close(pid)
                open_[pid] = [data]
                out.streams[pid].access.append(bool(adaptation & 0x40))
            elif pid in open_:
                open_[pid].append(data)
            else:
                out.orphans += 1
        elif pid in sections:
            for s in sections[pid].add(data, start):
                if pid == PAT_PID and s[0] == 0:
                    found = {int.from_bytes(s[i : i + 2], "big"): int.from_bytes(s[i + 2 : i + 4], "big") & 0x1FFF for i in range(8, len(s) - 4, 4)}
                    out.programs |= {k: v for k, v in found.items() if k}
                    maps = set(out.programs.values())
                    sections |= {p: _Sections() for p in maps - sections.keys()}
                elif pid in maps and s[0] == 2:
                    for p, kind in _map_entries(s):
                        out.streams.setdefault(p, Elementary(kind)).kind = kind
    for pid in list(open_):
        close(pid)
    return out


def encode(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, the text padded and stored as a transport stream, of every row; written once.

    A null text is empty; an empty text is one frame of padding.  Repeated rows and ids are rows like any other; an
    empty table gives no rows; other columns are ignored.
    """

    def write(batches):
        for batch in slices(batches, "text"):
            texts = texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array([mux(pad(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    docs = docs.select("doc_id", "text")
    return durable(docs.mapInArrow(write, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary"))


def decode(media: DataFrame) -> DataFrame:
    """What the stored streams of encode() hold: digests, the time stamps and random-access points, and a feature."""
    kinds = {"doc_id": None, "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "stamps": pa.list_(pa.int64()), "access_points": pa.list_(pa.int64())}

    def read(batches):
        for batch in slices(batches, "media"):
            rows = []
            for stored in texts_of(batch.column(2)):
                s = demux(stored)
                payload, stamps = s.payload, [x for e in s.streams.values() for x in e.stamps]
                feature = f"programs={len(s.programs)};streams={','.join(f'{e.kind:02x}' for e in s.streams.values())};packets={len(stored) // PACKET};pes={len(stamps)};gaps={s.gaps};access={len(s.access)};last_pts={stamps[-1]}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, stamps, s.access))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, list(kinds.values())[2:])]], list(kinds))

    id_type = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, stamps array<long>, access_points array<long>")
