"""Bit-code expressions. Codes are BINARY; bit ``i`` of byte ``b`` belongs to dimension ``8*b + i``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from nearspan.plans.kernels import matrix


def sign_code(v: Column, dims: int) -> Column:
    """One bit per dimension, set where the component is positive."""
    def byte(b: Column) -> Column:
        bits = F.transform(
            F.slice(v, b * 8 + 1, 8),
            lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1), i)).otherwise(F.lit(0)),
        )
        value = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
        return F.lpad(F.hex(value), 2, "0")

    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(dims // 8 - 1)), byte), "")
    return F.unhex(text)


def words(code: Column, dims: int) -> Column:
    """BINARY code as big-endian 64-bit words, the form ``functions.distance.hamming`` takes."""
    count = (dims + 63) // 64
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda w: F.conv(F.hex(F.substring(code, w * 8 + 1, F.lit(8))), 16, -10).cast("bigint"),
    )


def bit(code: Column, position: int) -> Column:
    """Value (0 or 1) of the bit of one dimension."""
    byte = F.conv(F.hex(F.substring(code, position // 8 + 1, 1)), 16, 10).cast("int")
    return F.shiftright(byte, position % 8).bitwiseAND(F.lit(1))


def leading_bits(code: Column, start: int, count: int) -> Column:
    """Bits ``start .. start+count-1`` packed in one BIGINT (bit ``start`` lowest); count <= 64. One unpacking per batch."""
    @F.arrow_udf("bigint")
    def packed_bits(codes: pa.Array) -> pa.Array:
        rows = np.unpackbits(matrix(codes), axis=1, bitorder="little")[:, start:start + count]
        full = np.zeros((len(rows), 64), np.uint8)
        full[:, :count] = rows
        return pa.array(np.packbits(full, axis=1, bitorder="little").view("<i8").ravel())

    return packed_bits(code)
