"""Bucket search over bit codes: the first bits of a code name its bucket."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.errors import ConfigError
from nearspan.functions.bits import leading_bits
from nearspan.operators.exact import ranked
from nearspan.plans.kernels import Scorer
from nearspan.plans.search import Ask, Limits, check_k, match_tables
from nearspan.session import attach

MASKS_PER_BATCH = 1 << 14


def flip_masks(bits: int, nflip: int) -> Iterator[np.ndarray]:
    """All masks with at most ``nflip`` of ``bits`` bits set, as signed 64-bit numbers, in arrays of bounded size."""
    masks = (sum(1 << i for i in c) for r in range(min(nflip, bits) + 1) for c in combinations(range(bits), r))
    while some := list(islice(masks, MASKS_PER_BATCH)):
        yield np.array(some, np.uint64).view(np.int64)


def _check(dims: int, hash_bits: int, nflip: int, tables: int) -> None:
    if not 0 < hash_bits <= 64 or hash_bits * tables > dims:
        raise ConfigError("hash bits must be 1..64, and tables * bits must fit in dims")
    if nflip < 0:
        raise ConfigError("nflip must be a non-negative integer")


def _probes(queries: DataFrame, keys: list[str], hash_bits: int, nflip: int) -> DataFrame:
    """``(query_id, code, t, key)``: every bucket a query asks for, made batch by batch in the tasks."""
    def flip(batches):
        for b in batches:
            for t, name in enumerate(keys):
                own = b.column(name).to_numpy()
                for masks in flip_masks(hash_bits, nflip):
                    step = max(1, (1 << 18) // len(masks))
                    for low in range(0, len(own), step):
                        some = own[low:low + step]
                        rows = pa.array(np.repeat(np.arange(low, low + len(some)), len(masks)))
                        yield pa.record_batch(
                            [b.column("query_id").take(rows), b.column("code").take(rows),
                             pa.array(np.full(len(rows), t, np.int32)), pa.array((some[:, None] ^ masks).ravel())],
                            ["query_id", "code", "t", "key"])

    return queries.mapInArrow(flip, "query_id long, code binary, t int, key long")


def search(base: DataFrame, queries: DataFrame, k: int, *, dims: int, hash_bits: int = 64, nflip: int = 0,
           tables: int = 1, limits: Limits = Limits()) -> DataFrame:
    """Top-k by Hamming distance among the rows whose bucket differs in at most ``nflip`` bits.

    With several tables, each takes its own run of bits, and a row found through more than one counts
    once. Buckets meet as groups of an equi-match; a bucket that holds a large share of the rows is cut.
    """
    check_k(k)
    _check(dims, hash_bits, nflip, tables)
    attach(base.sparkSession)
    names = [f"key_{t}" for t in range(tables)]
    keys = [leading_bits(F.col("code"), t * hash_bits, hash_bits).alias(n) for t, n in enumerate(names)]

    def bucket(t, key):
        return key if tables == 1 else F.xxhash64(t, key)

    own = base.select("vec_id", "code", *keys)
    b = own.select("vec_id", "code", F.explode(F.array(*[bucket(F.lit(t), F.col(n)) for t, n in enumerate(names)])).alias("bucket"))
    asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "code", *keys)
    q = _probes(asked, names, hash_bits, nflip).select("query_id", "code", bucket(F.col("t"), F.col("key")).alias("bucket"))
    hits = match_tables(b, q, Ask(Scorer("hamming"), k=k, repeats=tables > 1), group="bucket", base_vector="code",
                        query_vector="code", width=dims // 8, limits=limits)
    return ranked(hits, "hamming").withColumn("distance", F.col("distance").cast("int"))
