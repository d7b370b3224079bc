"""Wavelet matrix of token ids in one compressed byte string.

Layout: 4 bytes magic, 4 bytes header length, JSON header, then zstd frames. There is one bit-plane per bit of the ids,
most significant first, cut into blocks of BLOCK bits; each block is a frame of its own. The header keeps for each plane
the number of zeros, the offset of each block and the ones before it, so rank and select open one block per plane.
"""

import json

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK = 1 << 16
LEVEL = 1


def build(ids, bits, extra=None):
    """The file of an array of ids below 2**bits. ``extra`` is kept in the header."""
    order = np.asarray(ids, dtype=np.uint32 if bits > 16 else np.uint16)
    packer, frames, planes, at = zstandard.ZstdCompressor(level=LEVEL), [], [], 0
    for bit in range(bits - 1, -1, -1):
        plane = (order >> bit).astype(np.uint8) & 1
        offsets, ones, seen = [], [], 0
        for start in range(0, len(plane), BLOCK):
            part = plane[start : start + BLOCK]
            offsets.append(at)
            ones.append(seen)
            seen += int(part.sum(dtype=np.int64))
            frames.append(packer.compress(np.packbits(part).tobytes()))
            at += len(frames[-1])
        planes.append({"zeros": len(plane) - seen, "offsets": offsets, "ones": ones})
        set_ = plane.view(bool)
        # compress and flatnonzero: picking by a mask mispredicts on every other bit.
        order = np.concatenate([order.compress(~set_), order.compress(set_)])
    header = json.dumps({"n": len(order), "bits": bits, "planes": planes, "end": at, "extra": extra}).encode()
    return MAGIC + len(header).to_bytes(4, "little") + header + b"".join(frames)


class WaveletMatrix:
    """Reads a file made by ``build``: single tokens, counts and places without unpacking the rest, or everything."""

    def __init__(self, data):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a wavelet file")
        size = int.from_bytes(data[4:8], "little")
        self.header = json.loads(bytes(data[8 : 8 + size]))
        self.body = memoryview(data)[8 + size :]
        self.n, self.bits, self.extra = self.header["n"], self.header["bits"], self.header["extra"]
        self.planes = self.header["planes"]
        self.unpacker = zstandard.ZstdDecompressor()

    def _block(self, plane, number):
        offsets = self.planes[plane]["offsets"]
        if number + 1 < len(offsets):
            end = offsets[number + 1]
        else:
            after = self.planes[plane + 1]["offsets"] if plane + 1 < self.bits else []
            end = after[0] if after else self.header["end"]
        raw = self.unpacker.decompress(self.body[offsets[number] : end])
        return np.unpackbits(np.frombuffer(raw, np.uint8))[: min(BLOCK, self.n - number * BLOCK)]

    def _ones(self, plane, i):
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - self.planes[plane]["zeros"]
        number = i // BLOCK
        return self.planes[plane]["ones"][number] + int(self._block(plane, number)[: i % BLOCK].sum(dtype=np.int64))

    def access(self, i):
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            bit = int(self._block(plane, i // BLOCK)[i % BLOCK])
            ones = self._ones(plane, i)
            value = 2 * value + bit
            i = self.planes[plane]["zeros"] + ones if bit else i - ones
        return value

    def _range(self, value, start, end):
        """Where the occurrences of an id among positions [start, end) come to lie behind the last plane."""
        for plane in range(self.bits):
            before, within = self._ones(plane, start), self._ones(plane, end)
            if value >> (self.bits - 1 - plane) & 1:
                zeros = self.planes[plane]["zeros"]
                start, end = zeros + before, zeros + within
            else:
                start, end = start - before, end - within
        return start, end

    def rank(self, value, i):
        """How often an id occurs among the first i positions."""
        if value >> self.bits:
            return 0
        start, end = self._range(value, 0, min(i, self.n))
        return end - start

    def select(self, value, k):
        """The position of the k-th occurrence of an id, from 0; None if there are fewer."""
        if k < 0 or k >= self.rank(value, self.n):
            return None
        i = self._range(value, 0, self.n)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - plane) & 1
            wanted = i - self.planes[plane]["zeros"] if bit else i
            i = self._place(plane, bit, wanted)
        return i

    def _place(self, plane, bit, k):
        """The position of the k-th bit of one kind in a plane, from 0."""
        before = np.array(self.planes[plane]["ones"], dtype=np.int64)
        if not bit:
            before = np.arange(len(before), dtype=np.int64) * BLOCK - before
        number = int(np.searchsorted(before, k, side="right")) - 1
        places = np.flatnonzero(self._block(plane, number) == bit)
        return number * BLOCK + int(places[k - before[number]])

    def all(self):
        """All ids in order, undoing one plane after the other from the last."""
        order = np.zeros(self.n, dtype=np.uint32 if self.bits > 16 else np.uint16)
        count = len(self.planes[0]["offsets"]) if self.planes else 0
        for plane in range(self.bits - 1, -1, -1):
            blocks = [self._block(plane, b) for b in range(count)]
            set_ = np.concatenate(blocks).view(bool) if blocks else np.zeros(0, bool)
            zeros, back = self.planes[plane]["zeros"], np.empty_like(order)
            back[np.flatnonzero(~set_)] = order[:zeros]
            back[np.flatnonzero(set_)] = order[zeros:] | order.dtype.type(1 << (self.bits - 1 - plane))
            order = back
        return order
