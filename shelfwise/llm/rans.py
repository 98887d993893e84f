"""Static range asymmetric numeral system over blocks of token ids.

One table of frequencies serves all blocks. A block is coded by ``LANES`` interleaved coders: id
``i`` belongs to lane ``i % LANES``, and all lanes take each step together as one vector
operation. States are 64 bits wide and give out 32-bit words, which a decoder reads in the order
of steps and lanes. Every ``CHECKPOINT`` steps a block notes all states and the place in its
words, so that several decoders can share one block; sections between checkpoints carry a
checksum each.
"""

import struct
import zlib

import numpy as np

LANES = 1024
CHECKPOINT = 256  # steps between checkpoints
BLOCK = LANES * CHECKPOINT * 2  # ids in a full block
SCALE = 22  # bits of the summed frequencies
LOW = np.uint64(1 << 31)
MAGIC = b"rANS"
HEADER = struct.Struct("<4sIII")  # magic, ids, sections, words


class Table:
    """Frequencies scaled to sum to ``2 ** SCALE``; every counted id keeps at least one slot."""

    def __init__(self, counts: np.ndarray):
        counts = counts.astype(np.float64)
        seen = counts > 0
        spare = (1 << SCALE) - int(seen.sum())
        if spare < 0:
            raise ValueError("more ids than slots")
        share = counts * (spare / max(counts.sum(), 1.0))
        freq = np.floor(share).astype(np.int64) + seen
        left = (1 << SCALE) - int(freq.sum())
        if seen.any():  # the rest goes to the largest remainders, ties by id
            order = np.lexsort((np.arange(len(counts)), -(share - np.floor(share)) * seen))
            freq[order[:left]] += 1
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block as bytes: header, checksums, checkpoints, words."""
    steps = -(-len(ids) // LANES)
    tail = len(ids) - (steps - 1) * LANES
    freq = table.freq[ids]
    start = table.start[ids]
    limit = freq << np.uint64(63 - SCALE)  # a state from here on gives out a word first
    state = np.full(LANES, LOW)
    words: list[np.ndarray] = []
    marks: list[tuple[np.ndarray, int]] = []
    given = 0
    for step in range(steps - 1, -1, -1):
        n = tail if step == steps - 1 else LANES
        at = slice(step * LANES, step * LANES + n)
        lanes = state[:n]
        full = lanes >= limit[at]
        if full.any():
            out = (lanes[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            lanes[full] >>= np.uint64(32)
            words.append(out)
            given += len(out)
        turn = lanes // freq[at]
        state[:n] = (turn << np.uint64(SCALE)) + (lanes - turn * freq[at]) + start[at]
        if step % CHECKPOINT == 0:
            marks.append((state.copy(), given))
    marks.reverse()
    stream = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    sums = [zlib.crc32(np.ascontiguousarray(ids[i:i + LANES * CHECKPOINT], "<u2").tobytes())
            for i in range(0, len(ids), LANES * CHECKPOINT)]
    places = [given - mark for _, mark in marks]
    return b"".join([
        HEADER.pack(MAGIC, len(ids), len(marks), given), np.array(sums, "<u4").tobytes(),
        np.array(places, "<u4").tobytes(),
        *(mark.astype("<u8").tobytes() for mark, _ in marks), stream.astype("<u4").tobytes()])


def sections(block: bytes) -> int:
    return HEADER.unpack_from(block)[2]


def decode_section(block: bytes, number: int, table: Table) -> np.ndarray:
    """The ids between one checkpoint and the next, checked against their checksum."""
    magic, n_ids, n_sections, n_words = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block")
    at = HEADER.size
    want = int(np.frombuffer(block, "<u4", n_sections, at)[number])
    place = int(np.frombuffer(block, "<u4", n_sections, at + 4 * n_sections)[number])
    at += 8 * n_sections
    state = np.frombuffer(block, "<u8", LANES, at + 8 * LANES * number).astype(np.uint64)
    words = np.frombuffer(block, "<u4", n_words, at + 8 * LANES * n_sections)
    begin = number * LANES * CHECKPOINT
    n_left = min(n_ids - begin, LANES * CHECKPOINT)
    ids = np.empty(n_left, np.uint16)
    mask = np.uint64((1 << SCALE) - 1)
    for done in range(0, n_left, LANES):
        n = min(LANES, n_left - done)
        lanes = state[:n]
        slot = lanes & mask
        found = table.slots[slot]
        ids[done:done + n] = found
        lanes = table.freq[found] * (lanes >> np.uint64(SCALE)) + slot - table.start[found]
        low = np.flatnonzero(lanes < LOW)
        if len(low):
            lanes[low] = (lanes[low] << np.uint64(32)) | words[place:place + len(low)]
            place += len(low)
        state[:n] = lanes
    if zlib.crc32(ids.astype("<u2").tobytes()) != want:
        raise ValueError("checksum differs")
    return ids


def decode_block(block: bytes, table: Table) -> np.ndarray:
    parts = [decode_section(block, i, table) for i in range(sections(block))]
    return np.concatenate(parts) if parts else np.empty(0, np.uint16)


def crc32_joined(first: int, second: int, length: int) -> int:
    """Checksum of two byte strings in a row from theirs and the length of the second."""
    # Multiplying by x^(8 * length) modulo the polynomial, bit by bit over squarings.
    power, factor, n = 0x80000000, 0x00800000, length  # 1 and x^8, reflected
    while n:
        if n & 1:
            power = _times(power, factor)
        factor = _times(factor, factor)
        n >>= 1
    return _times(first, power) ^ second


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo that of CRC-32, reflected."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product
