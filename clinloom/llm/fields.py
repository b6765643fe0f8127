"""Bit fields of bounded size that tell which hashes of a corpus more than one owner has.

Hashes are dealt to groups by some of their bits, each group makes its part of
the field, and the parts side by side are the field. It may hold hashes that
only one owner has (where two share a bit), never miss one that several have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of a field at most.
MOST_BITS = 28


class Field:
    def __init__(self, groups_log: int, bits_log: int):
        self.groups_log, self.bits_log = groups_log, max(groups_log + 3, min(MOST_BITS, bits_log))

    @classmethod
    def for_hashes(cls, width: int, hashes: int, bits: int = 16) -> Field:
        """About so many bits a hash, in at least four groups a partition."""
        return cls(max(4, (4 * width - 1).bit_length(), (hashes >> 23).bit_length()), (bits * hashes).bit_length() - 1)

    def split(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group, and number in it, of 64-bit hashes."""
        high = code >> np.uint64(32 - self.groups_log)
        return (high & np.uint64((1 << self.groups_log) - 1)).astype(np.int64), (high >> np.uint64(self.groups_log)).astype(np.uint32)

    def bit(self, number: np.ndarray) -> np.ndarray:
        """Place of a number in its group's part of the field."""
        return (number >> np.uint32(32 - (self.bits_log - self.groups_log))).astype(np.int64)

    def holds(self, field: np.ndarray, code: np.ndarray) -> np.ndarray:
        group, number = self.split(code)
        bit = (group << (self.bits_log - self.groups_log)) + self.bit(number)
        return (field[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

    def packed(self, code: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        """Per group: the numbers of some hashes, and which of them two owners have."""
        group, number = self.split(code)
        by = np.lexsort((owner, number, group))
        group, number, owner = group[by], number[by], owner[by]
        new = np.ones(len(by), bool)
        new[1:] = (group[1:] != group[:-1]) | (number[1:] != number[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(by)) - 1 if len(at) else at
        twice = owner[at] != owner[last]
        group, number = group[at], number[at]
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        ends = np.append(cuts[1:], len(group)) if len(cuts) else cuts
        numbers = [number[a:b].astype("<u4").tobytes() for a, b in zip(cuts, ends)]
        flags = [np.packbits(twice[a:b]).tobytes() for a, b in zip(cuts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(group[cuts], pa.int64()), pa.array(numbers, pa.binary()), pa.array(flags, pa.binary())], names=["group", "numbers", "twice"])

    def marked(self, code: np.ndarray) -> pa.RecordBatch:
        """Per group: hashes that the field is to hold in any case."""
        return self.packed(np.repeat(code, 2), np.arange(2 * len(code)))

    def part(self, group: pa.Table) -> pa.Table:
        """A group's part of the field: what two of the packed rows have, or one of them twice."""
        numbers = [np.frombuffer(x, "<u4") for x in group["numbers"].to_pylist()]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)).astype(bool) for x, n in zip(group["twice"].to_pylist(), numbers)]
        number, again = np.concatenate(numbers), np.concatenate(flags)
        by = np.argsort(number, kind="stable")
        number, again = number[by], again[by]
        again[1:] |= number[1:] == number[:-1]
        bits = np.zeros(1 << (self.bits_log - self.groups_log), np.uint8)
        bits[self.bit(number[again])] = 1
        return pa.table(
            {"group": [group["group"][0].as_py()], "bits": [np.packbits(bits, bitorder="little").tobytes()]},
            schema=pa.schema([("group", pa.int64()), ("bits", pa.binary())]),
        )

    def gather(self, packed: DataFrame):
        """The whole field, sent to all executors; its size does not grow with the input beyond MOST_BITS."""
        field = np.zeros(1 << (self.bits_log - 3), np.uint8)
        size = len(field) >> self.groups_log
        parts = packed.groupBy("group").applyInArrow(lambda group: self.part(group), "group long, bits binary").toArrow()
        for group, bits in zip(parts["group"].to_pylist(), parts["bits"].to_pylist()):
            field[group * size : (group + 1) * size] = np.frombuffer(bits, np.uint8)
        return packed.sparkSession.sparkContext.broadcast(field.tobytes())


PACKED = "group long, numbers binary, twice binary"
