"""A counting quotient filter over integer fingerprints, in numpy.

A fingerprint is cut into a quotient, the home slot, and a remainder, which is
stored.  The remainders of one quotient form a run, sorted; runs that do not
fit at home shift to the right.  Three bits a slot say which quotients have a
run, where runs end and which slots hold counters: a fingerprint seen more
than once is followed by the digits of its count.  Nothing is lost: the sorted
fingerprints and their counts can be read back, so filters merge by merging
their sorted remainders, whatever their sizes.
"""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
LOAD = 0.8


def _bits(x: int) -> int:
    return max(int(x).bit_length(), 1)


class CountingQuotientFilter:
    def __init__(self, quotient_bits: int, remainder_bits: int, occupied, run_end, counter, remainder):
        self.quotient_bits, self.remainder_bits = quotient_bits, remainder_bits
        self.occupied, self.run_end, self.counter, self.remainder = occupied, run_end, counter, remainder

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> CountingQuotientFilter:
        """Of ascending, distinct fingerprints of ``bits`` bits and their counts."""
        fingerprints, counts = fingerprints.astype(U64), counts.astype(U64)
        n = len(fingerprints)
        q = min(_bits(int(n / LOAD)), bits - 1)
        r = bits - q
        digits = np.zeros(n, np.int64)
        many = counts > 1
        if many.any():
            # a count needs as many digits to the base 2^r as leave nothing of it
            rest = counts[many]
            width = np.zeros(len(rest), np.int64)
            while rest.any():
                width += rest > 0
                rest = rest >> U64(r)
            digits[many] = width
        home = (fingerprints >> U64(r)).astype(np.int64)
        low = fingerprints & U64((1 << r) - 1)
        length = 1 + digits
        ahead = np.cumsum(length) - length
        at = ahead + np.maximum.accumulate(home - ahead) if n else home
        slots = max(1 << q, int(at[-1] + length[-1]) if n else 0)
        occupied, run_end, counter = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
        remainder = np.zeros(slots, U64)
        if n:
            occupied[home] = True
            last = np.append(home[1:] != home[:-1], True)
            run_end[(at + length - 1)[last]] = True
            remainder[at] = low
            for j in range(int(digits.max())):
                has = digits > j
                counter[at[has] + 1 + j] = True
                remainder[at[has] + 1 + j] = (counts[has] >> U64(r * j)) & U64((1 << r) - 1)
        return cls(q, r, occupied, run_end, counter, remainder)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints ascending, counts)."""
        home, end = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        if not len(home):
            return np.zeros(0, U64), np.zeros(0, np.int64)
        start = np.maximum(home, np.append(-1, end[:-1]) + 1)
        length = end - start + 1
        slot = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())
        head = ~self.counter[slot]
        first = np.flatnonzero(head)
        value = (np.repeat(home, length)[first].astype(U64) << U64(self.remainder_bits)) | self.remainder[slot[first]]
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        digit = np.where(head, U64(0), self.remainder[slot] << (U64(self.remainder_bits) * np.maximum(place - 1, 0).astype(U64)))
        counts = np.add.reduceat(digit, first).astype(np.int64)
        return value, np.maximum(counts, 1)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter of all entries; their counts add up."""
        bits = filters[0].quotient_bits + filters[0].remainder_bits
        read = [f.entries() for f in filters]
        return cls.build(*summed(np.concatenate([x[0] for x in read]), np.concatenate([x[1] for x in read])), bits)

    def to_bytes(self) -> bytes:
        wide = -(-self.remainder_bits // 8)
        low = np.ascontiguousarray(self.remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide])
        flags = b"".join(np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter))
        return struct.pack("<BBq", self.quotient_bits, self.remainder_bits, len(self.remainder)) + flags + low.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        q, r, slots = struct.unpack_from("<BBq", data)
        at, flags = struct.calcsize("<BBq"), []
        for n in (1 << q, slots, slots):
            size = -(-n // 8)
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n).astype(bool))
            at += size
        wide = -(-r // 8)
        low = np.zeros((slots, 8), np.uint8)
        low[:, :wide] = np.frombuffer(data, np.uint8, slots * wide, at).reshape(slots, wide)
        return cls(q, r, *flags, low.view("<u8").ravel())


def summed(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints and the sums of their counts; sorted stretches are merged, not sorted anew."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.append(True, fingerprints[1:] != fingerprints[:-1])) if len(order) else order
    return fingerprints[first], np.add.reduceat(counts, first) if len(first) else counts
