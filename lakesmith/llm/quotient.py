"""Counting quotient filters over packed ids, without loss.

A tuple of ids, each of ``bits`` bits, is one number of ``count * bits`` bits. A Feistel network permutes these
numbers: its two halves are XORed in turn with a mix of the other, which the same rounds undo backwards. The
permuted number's first bits are the bucket (a shard), the next the quotient, all others the remainder. A
filter keeps, for a bucket, the run length of each quotient, the remainders in full and the counters, all in ascending order;
so the numbers, and with them the tuples, come back exactly, and filters of one bucket merge as sorted lists.

A number of over 64 bits is held as its first 64 bits, ``top``, and its ``rest``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
CODEC = pa.Codec("zstd", compression_level=1)


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ U(salt)) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


@dataclass(frozen=True)
class Layout:
    """Tuples of ``count`` ids of ``bits`` bits (32 at most), dealt over ``2 ** shard_bits`` buckets."""

    count: int
    bits: int
    shard_bits: int

    @property
    def left(self) -> int:
        return self.count // 2

    @property
    def halves(self) -> tuple[int, int]:
        return self.left * self.bits, (self.count - self.left) * self.bits

    @property
    def top_bits(self) -> int:
        return min(64, self.count * self.bits)

    @property
    def rest_bits(self) -> int:
        return self.count * self.bits - self.top_bits

    def permuted(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(top, rest) of the tuples whose ids stand in ``ids``, one array for each place."""
        a, b = (self._packed(part) for part in (ids[: self.left], ids[self.left :]))
        wide_a, wide_b = self.halves
        for k, salt in enumerate(ROUNDS):
            if k % 2 == 0:
                a = a ^ (_mixed(b, salt) & _mask(wide_a))
            else:
                b = b ^ (_mixed(a, salt) & _mask(wide_b))
        if self.rest_bits == 0:
            return (a << U(wide_b)) | b, np.zeros(len(a), U)
        room = 64 - wide_a
        top = (a << U(room)) | (b >> U(wide_b - room)) if room else a
        return top, b & _mask(wide_b - room)

    def restored(self, top: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
        """The ids that ``permuted`` was given."""
        wide_a, wide_b = self.halves
        if self.rest_bits == 0:
            a, b = top >> U(wide_b), top & _mask(wide_b)
        else:
            room = 64 - wide_a
            a = top >> U(room)
            b = ((top & _mask(room)) << U(wide_b - room)) | rest if room else rest
        for k, salt in reversed(list(enumerate(ROUNDS))):
            if k % 2 == 0:
                a = a ^ (_mixed(b, salt) & _mask(wide_a))
            else:
                b = b ^ (_mixed(a, salt) & _mask(wide_b))
        return self._unpacked(a, self.left) + self._unpacked(b, self.count - self.left)

    def _packed(self, ids: list[np.ndarray]) -> np.ndarray:
        total = ids[0].astype(U)
        for more in ids[1:]:
            total = (total << U(self.bits)) | more.astype(U)
        return total

    def _unpacked(self, number: np.ndarray, n: int) -> list[np.ndarray]:
        return [((number >> U(self.bits * k)) & _mask(self.bits)).astype(np.int64) for k in range(n - 1, -1, -1)]

    def split(self, n: int) -> tuple[int, int]:
        """(quotient bits, remainder bits within ``top``) for a bucket of ``n`` numbers: whole bytes of remainder, up to two quotients a number."""
        room = self.top_bits - self.shard_bits
        remainder = -(-max(room - max(n, 1).bit_length(), 0) // 8) * 8
        return (room - remainder, remainder) if remainder <= room else (0, room)


def counted(top: np.ndarray, rest: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers in ascending order with the sums of their counts (1 each if none are given)."""
    if counts is None and not rest.any():
        top, rest = np.sort(top), rest
    else:
        order = np.argsort(top)
        top, rest = top[order], rest[order]
        counts = None if counts is None else counts[order]
        same = top[1:] == top[:-1]
        if (same & (rest[1:] != rest[:-1])).any():  # equal first 64 bits, other rests
            run = np.cumsum(np.concatenate([[True], ~same])[: len(top)]) - 1
            mixed = np.zeros(run[-1] + 1, bool)
            mixed[run[1:][same & (rest[1:] != rest[:-1])]] = True
            at = np.flatnonzero(mixed[run])
            by = at[np.lexsort((rest[at], top[at]))]
            rest[at] = rest[by]
            if counts is not None:
                counts[at] = counts[by]
    if not len(top):
        return top, rest, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (top[1:] != top[:-1]) | (rest[1:] != rest[:-1])]))
    sums = np.diff(np.append(first, len(top))) if counts is None else np.add.reduceat(counts, first)
    return top[first], rest[first], sums.astype(np.int64)


def _least(values: np.ndarray) -> np.ndarray:
    """``values`` in the least unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _squeezed(values: np.ndarray) -> bytes:
    values = _least(values)
    return bytes([values.itemsize]) + CODEC.compress(values.tobytes(), asbytes=True)


def _loosened(data: bytes, n: int) -> np.ndarray:
    size = data[0]
    return np.frombuffer(CODEC.decompress(data[1:], n * size, asbytes=True), f"<u{size}") if n else np.zeros(0, np.uint8)


def _bytes(values: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)]).tobytes()


def _numbers(data: bytes, n: int, bits: int) -> np.ndarray:
    wide, size = np.zeros((n, 8), np.uint8), -(-bits // 8)
    wide[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return wide.view("<u8").reshape(-1).astype(U)


def filters(layout: Layout, top: np.ndarray, rest: np.ndarray, counts: np.ndarray):
    """Of ascending numbers, each bucket's filter: (bucket, n, quotient bits, run lengths, remainders, counters)."""
    bucket = top >> U(layout.top_bits - layout.shard_bits) if layout.shard_bits else np.zeros(len(top), U)
    cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(top)) if len(top) else []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        n = int(hi - lo)
        quotient_bits, remainder_bits = layout.split(n)
        own = top[lo:hi] & _mask(layout.top_bits - layout.shard_bits)
        runs = np.bincount((own >> U(remainder_bits)).astype(np.int64), minlength=1 << quotient_bits)
        remainders = _bytes(own & _mask(remainder_bits), remainder_bits) + _bytes(rest[lo:hi], layout.rest_bits)
        yield int(bucket[lo]), n, quotient_bits, _squeezed(runs), remainders, _squeezed(counts[lo:hi])


def opened(layout: Layout, bucket: int, n: int, quotient_bits: int, runs: bytes, remainders: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers and counts of a filter."""
    room = layout.top_bits - layout.shard_bits
    remainder_bits = room - quotient_bits
    quotient = np.repeat(np.arange(1 << quotient_bits, dtype=U), _loosened(runs, 1 << quotient_bits).astype(np.int64))
    size = n * -(-remainder_bits // 8)
    top = (U(bucket) << U(room) if layout.shard_bits else U(0)) | (quotient << U(remainder_bits)) | _numbers(remainders[:size], n, remainder_bits)
    return top, _numbers(remainders[size:], n, layout.rest_bits), _loosened(counts, n).astype(np.int64)
