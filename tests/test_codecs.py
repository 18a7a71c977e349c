"""Inner codecs and shuffles of compressed chunks, against bytes written out by hand and a plain encoder."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from covoxel.sources import zarr


def short_lz(data):
    """A greedy encoder: matches of three bytes or more at the nearest place that holds the next three bytes."""
    out, plain, seen, i = bytearray(), bytearray(), {}, 0

    def literals():
        for k in range(0, len(plain), 32):
            part = plain[k : k + 32]
            out.extend([len(part) - 1, *part])
        plain.clear()

    while i < len(data):
        at = seen.get(data[i : i + 3], -1)
        n = 0
        if at >= 0 and i - at - 1 < 8191 + 65536:
            while i + n < len(data) and data[at + n] == data[i + n]:
                n += 1
        if n >= 3:
            literals()
            back, code = i - at - 1, min(n - 2, 7)
            far = back >= 8191
            out.append(code << 5 | (31 if far else back >> 8))
            if code == 7:
                rest = n - 9
                out.extend([255] * (rest // 255) + [rest % 255])
            out.extend([255, *(back - 8191).to_bytes(2, "big")] if far else [back & 255])
        else:
            n = 1
            plain.append(data[i])
        for k in range(i, i + n):
            seen[data[k : k + 3]] = k
        i += n
    literals()
    return bytes(out)


def bits_apart(data, width):
    """The plane of bit 0 of all elements, then of bit 1, and so on, bit by bit."""
    n = len(data) // width
    if n % 8:
        return data
    out = bytearray(len(data))
    for b in range(8 * width):
        for e in range(n):
            if data[e * width + b // 8] >> b % 8 & 1:
                out[b * (n // 8) + e // 8] |= 1 << e % 8
    return bytes(out)


def container(data, width, inner, flags, block):
    """A container of blocks of one stream each; a stream that doesn't shrink is stored as it is."""
    body, starts, first = b"", [], 16 + 4 * -(-len(data) // block)
    for k in range(0, len(data), block):
        part = data[k : k + block]
        whole = len(part) // width * width
        if flags & 4:
            part = bits_apart(part[:whole], width) + part[whole:]
        elif flags & 1:
            part = np.frombuffer(part[:whole], np.uint8).reshape(-1, width).T.tobytes() + part[whole:]
        packed = ENCODERS[inner](part)
        packed = packed if len(packed) < len(part) else part
        starts.append(first + len(body))
        body += len(packed).to_bytes(4, "little") + packed
    head = bytes([2, 1, flags | 16 | inner << 5, width]) + b"".join(n.to_bytes(4, "little") for n in (len(data), block, first + len(body)))
    return head + b"".join(s.to_bytes(4, "little") for s in starts) + body


ENCODERS = {0: short_lz, 1: lambda b: pa.compress(b, codec="lz4_raw", asbytes=True), 2: lambda b: pa.compress(b, codec="snappy", asbytes=True), 3: zlib.compress, 4: lambda b: pa.compress(b, codec="zstd", asbytes=True)}


@pytest.mark.parametrize("raw, want", [
    (b"\x02abc", b"abc"),
    (b"\x02abc\x20\x02", b"abcabc"),  # three bytes from three before
    (b"\x00a\xe0\xff\x24\x00", b"a" * 301),  # 9 + 255 + 36 bytes that reach into themselves
    (b"\x01xy\x40\x01\x00z", b"xyxyxyz"),
])
def test_bytes_by_hand(raw, want):
    assert zarr._short_lz(raw, len(want)) == want


def test_far_matches():
    gap = bytes(np.random.default_rng(1).integers(0, 256, 9000).astype(np.uint8))
    data = b"a passage" + gap + b"a passage"
    packed = short_lz(data)
    assert b"\xff" + (9008 - 8191).to_bytes(2, "big") in packed and zarr._short_lz(packed, len(data)) == data


def test_matches_before_the_block_are_refused():
    with pytest.raises(ValueError):
        zarr._short_lz(b"\x00a\x20\x05", 4)


def test_bits_by_hand():
    assert zarr._bits_together(bytes([0b10000001, 0, 0, 0, 0, 0, 0, 0b00000010]), 1) == bytes([1, 128, 0, 0, 0, 0, 0, 1])


@pytest.mark.parametrize("inner", list(ENCODERS))
@pytest.mark.parametrize("flags", [0, 1, 4])
def test_containers(inner, flags):
    rng = np.random.default_rng(inner)
    for width, n in ((1, 1000), (2, 800), (2, 803), (4, 999), (8, 64)):
        data = (rng.integers(0, 4, n) * rng.integers(0, 2, n)).astype(f"<u{width}").tobytes()
        for block in (len(data), 256 * width):
            assert zarr._blosc(container(data, width, inner, flags, block), len(data)) == data


def test_unknown_codecs_are_refused():
    with pytest.raises(ValueError):
        zarr._blosc(bytes([2, 1, 16 | 7 << 5, 1]) + bytes(12), 0)
