"""ZIP packages with stored members: a streaming writer and a range reader.

The writer never seeks: a member's checksum and size follow it in a data
descriptor and stand in the central directory.  Sizes and offsets of 4 GiB or
more, or more than 65,534 members, get ZIP64 records.  The reader looks only at
the end of the file, the central directory (ZIP64 where named) and the members'
local headers; a stored member's bytes can then be read by range."""

from __future__ import annotations

import struct
import zlib

BIG32, BIG16 = 0xFFFFFFFF, 0xFFFF
DOS_DATE = 0x21  # 1980-01-01, the earliest date of the format


class ZipWriter:
    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []
        self.name: bytes | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        self._put(struct.pack("<4s5H3L2H", b"PK\3\4", 45, 8 | 0x800, 0, 0, DOS_DATE, 0, 0, 0, len(self.name), 0) + self.name)

    def write(self, data: bytes) -> int:
        """Append to the open member; returns the data's offset within it."""
        at = self.size
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._put(data)
        return at

    def end(self) -> None:
        wide = self.zip64 or self.size >= BIG32
        self._put(struct.pack("<4sL2Q" if wide else "<4sL2L", b"PK\7\10", self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.crc, self.size))

    def close(self) -> None:
        start = self.at
        for name, at, crc, size in self.members:
            wide = self.zip64 or size >= BIG32 or at >= BIG32
            extra = struct.pack("<2H3Q", 1, 24, size, size, at) if wide else b""
            a, s = (BIG32, BIG32) if wide else (at, size)
            self._put(struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 8 | 0x800, 0, 0, DOS_DATE, crc, s, s,
                                  len(name), len(extra), 0, 0, 0, 0, a) + name + extra)
        size, n, end = self.at - start, len(self.members), self.at
        if self.zip64 or n >= BIG16 or start >= BIG32 or size >= BIG32:
            self._put(struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<4sLQL", b"PK\6\7", 0, end, 1))
            n, size, start = BIG16, BIG32, BIG32
        self._put(struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, n, n, size, start, 0))


def _range(f, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (offset of the data, stored size, method) of a seekable file."""
    tail_at = max(0, size - 22 - BIG16)
    tail = _range(f, tail_at, size - tail_at)
    # the comment may hold the marker: the right one's comment ends the file
    found = len(tail)
    while True:
        found = tail.rfind(b"PK\5\6", 0, found)
        if found < 0:
            raise ValueError("no ZIP directory")
        if found + 22 <= len(tail) and found + 22 + struct.unpack_from("<H", tail, found + 20)[0] == len(tail):
            break
    n, length, at = struct.unpack_from("<H2L", tail, found + 10)
    if (n == BIG16 or BIG32 in (length, at)) and tail_at + found >= 20:
        locator = _range(f, tail_at + found - 20, 20)
        if locator[:4] == b"PK\6\7":
            end64 = _range(f, struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != b"PK\6\6":
                raise ValueError("broken ZIP64 directory")
            n, length, at = struct.unpack_from("<3Q", end64, 32)
    central, p, out = _range(f, at, length), 0, {}
    for _ in range(n):
        if central[p:p + 4] != b"PK\1\2":
            raise ValueError("broken ZIP directory")
        method, = struct.unpack_from("<H", central, p + 10)
        packed, full, a, b, c = struct.unpack_from("<2L3H", central, p + 20)
        start, = struct.unpack_from("<L", central, p + 42)
        name = central[p + 46:p + 46 + a].decode()
        extra, q = central[p + 46 + a:p + 46 + a + b], 0
        while q + 4 <= len(extra):
            kind, width = struct.unpack_from("<2H", extra, q)
            if kind == 1:  # the values that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, q + 4))
                full = next(wide) if full == BIG32 else full
                packed = next(wide) if packed == BIG32 else packed
                start = next(wide) if start == BIG32 else start
            q += 4 + width
        head = _range(f, start, 30)
        skip = sum(struct.unpack_from("<2H", head, 26))
        out[name] = (start + 30 + skip, packed, method)
        p += 46 + a + b + c
    return out
