"""CRC-32C of many byte ranges at once, with numpy.

The checksum is linear, so a range is cut into chunks whose checksums are taken side by side,
one 32-bit word at a time, and then joined. Leading zeros don't change it (with a zero start
value), so chunks are filled up in front.
"""

from __future__ import annotations

from functools import cache

import numpy as np

POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
CHUNK = 256


def _linear(image: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Tables for the low and high half-word of a linear map, given by the image of each bit."""
    tables = []
    for half in (image[:16], image[16:]):
        table = np.zeros(1, np.uint32)
        for value in half:
            table = np.concatenate([table, table ^ np.uint32(value)])
        tables.append(table)
    return tables[0], tables[1]


def _apply(tables: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    return tables[0][x & np.uint32(0xFFFF)] ^ tables[1][x >> np.uint32(16)]


@cache
def _tables() -> tuple[tuple, tuple]:
    """Maps of a checksum over one zero word, and over a chunk of zeros."""
    image = []
    for bit in range(32):
        value = 1 << bit
        for _ in range(32):
            value = (value >> 1) ^ (POLYNOMIAL if value & 1 else 0)
        image.append(value)
    word = _linear(image)
    power, steps = image, CHUNK // 4
    while steps > 1:  # CHUNK / 4 is a power of two
        power = [int(x) for x in _apply(_linear(power), np.array(power, np.uint32))]
        steps //= 2
    return word, _linear(power)


def crc32c(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The checksum of each range of a uint8 array."""
    word, chunk = _tables()
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    chunks = np.maximum(1, -(-lengths // CHUNK))
    first = np.concatenate([[0], np.cumsum(chunks)])
    padded = np.zeros(int(first[-1]) * CHUNK, np.uint8)
    ends = (first[1:] * CHUNK).tolist()
    for end, start, length in zip(ends, starts.tolist(), lengths.tolist()):
        at = end - length
        padded[at:end] = data[start : start + length]
        padded[at : min(end, at + 4)] ^= 255
    columns = np.ascontiguousarray(padded.view("<u4").reshape(-1, CHUNK // 4).T)
    each = np.zeros(len(columns[0]) if len(padded) else 0, np.uint32)
    for column in columns if len(padded) else ():
        each = _apply(word, each ^ column)
    total = np.zeros(len(lengths), np.uint32)
    for k in range(int(chunks.max(initial=0))):
        active = int(np.searchsorted(-chunks, -k, "left"))  # those with more than k chunks
        total[:active] = _apply(chunk, total[:active]) ^ each[first[:active] + k]
    out = np.empty(len(lengths), np.uint32)
    # A range shorter than the start value leaves the rest of that value in the checksum.
    rest = np.uint32(0xFFFFFFFF) >> (8 * np.minimum(lengths, 4)).astype(np.uint64)
    out[order] = total ^ rest.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated right by 15 bits and shifted, so that a checksum of checksums is safe."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
