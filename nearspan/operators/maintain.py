"""Table maintenance: append, merge, remove, reset, look up, inspect, check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.errors import ConfigError, DimensionError
from nearspan.functions.vectors import is_valid
from nearspan.operators.exact import hamming_knn, knn
from nearspan.operators.prep import numbered

STATS_FIELDS = ("ntotal", "dims", "is_trained", "kind", "metric")
# fixed values: names of the checks, in order
DIMENSIONS, COUNT, BYTES, SAMPLE, SELF = "dimensions", "vectorCount", "bytesPerVector", "reconstruct", "selfSearch"


def next_id(table: DataFrame) -> int:
    return table.agg(F.coalesce(F.max("vec_id") + 1, F.lit(0))).first()[0]


def append(table: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Old rows plus the new ones, which get the ids after the largest one, in ``order``."""
    fresh = numbered(new, order, start=next_id(table), out="vec_id")
    return table.unionByName(fresh.select(*table.columns))


def merge(table: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``other`` after those of ``table``: its ids move up by the next free id.

    Both tables must have equal columns and every vector (or code) of both the same width; neither is changed.
    """
    seen = {w for t in (table, other) for w in _widths(t)}
    if len(seen) > 1:
        raise DimensionError(f"cannot merge vectors of widths {sorted(seen, key=str)}")
    moved = other.withColumn("vec_id", F.col("vec_id") + F.lit(next_id(table)))
    return table.unionByName(moved.select(*table.columns))


def _widths(table: DataFrame) -> set[int]:
    """Smallest and largest width of a table of vectors or codes."""
    width = F.octet_length("code") if "code" in table.columns else F.size("embedding")
    row = table.agg(F.min(width).alias("low"), F.max(width).alias("high")).first()
    return {w for w in row if w is not None}


def remove(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not listed. Removed ids are not given out again by this call."""
    return table.join(ids.select("vec_id").distinct(), "vec_id", "left_anti").select(*table.columns)


def removed_count(table: DataFrame, ids: DataFrame) -> DataFrame:
    """One row ``removed``: how many rows :func:`remove` takes away."""
    return (table.select("vec_id").join(ids.select("vec_id"), "vec_id", "left_semi")
            .agg(F.count(F.lit(1)).alias("removed")))


def reset(table: DataFrame) -> DataFrame:
    """The empty table of the same schema; models stay as they are."""
    return table.limit(0)


def lookup(table: DataFrame, ids: DataFrame) -> DataFrame:
    """``(pos, vec_id, ...)`` of the listed ids, one row per request, so repeated ids stay repeated and an id that the
    table does not hold comes back with null columns."""
    return ids.select("pos", "vec_id").join(table, "vec_id", "left").select("pos", *table.columns)


def stats(table: DataFrame, *, dims: int, kind: str, metric: str, is_trained: bool = True) -> DataFrame:
    """One row of :data:`STATS_FIELDS`; for bit codes also ``bytes_per_vector``."""
    more = [F.lit(dims // 8).alias("bytes_per_vector")] if metric == "hamming" else []
    return table.agg(F.count(F.lit(1)).alias("ntotal")).select(
        "ntotal", F.lit(dims).alias("dims"), F.lit(is_trained).alias("is_trained"),
        F.lit(kind).alias("kind"), F.lit(metric).alias("metric"), *more)


def list_skew(assigned: DataFrame) -> DataFrame:
    """One row about the list sizes: lists in use, smallest, largest, mean, largest over mean."""
    sizes = assigned.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("lists"), F.min("n").alias("smallest"), F.max("n").alias("largest"),
        F.avg("n").alias("mean"), (F.max("n") / F.avg("n")).alias("skew"))


def hints(spark: SparkSession, *, kind: str, metric: str) -> DataFrame:
    """``(hint)`` rows that fit the kind of table."""
    rows: list[tuple[str]] = []
    if kind.startswith("IVF"):
        rows.append(("nprobe trades the share of neighbours found for time",))
        rows.append(("a skew far above 1 means uneven lists: train with more of them",))
    if metric == "ip":
        rows.append(("inner products equal cosines only between unit vectors",))
    return spark.createDataFrame(rows, T.StructType([T.StructField("hint", T.StringType())]))


def sample_ids(table: DataFrame, ntotal: int, size: int) -> DataFrame:
    """Ids at every floor(n/size)-th position in id order, ``size`` of them, and the last one."""
    step, at = max(1, ntotal // size), F.col("seq")
    wanted = ((at % step == 0) & (at < size * step)) | (at == ntotal - 1)
    return numbered(table.select("vec_id"), ["vec_id"]).where(wanted).select("vec_id")


def check(table: DataFrame, *, dims: int, metric: str = "l2", sample_size: int = 3,
          vector: Column | None = None) -> DataFrame:
    """Rows ``(check, passed, message)``: width, count, sampled vectors, and that the first sampled
    vector finds something. ``vector`` is the decoding expression of an encoded table. A table of bit codes (metric
    ``hamming``) is also checked for its bytes per vector."""
    if sample_size < 0:
        raise ConfigError("sample_size must not be negative")
    spark = table.sparkSession
    bits = metric == "hamming"
    column = "code" if bits else "embedding"
    vector = F.col(column) if vector is None else vector
    ntotal = table.count()
    checks = [(DIMENSIONS, dims > 0, f"dims={dims}"), (COUNT, ntotal >= 0, f"ntotal={ntotal}")]
    if bits:
        widths = _widths(table)
        checks.append((BYTES, widths <= {dims // 8}, f"bytesPerVector={','.join(map(str, sorted(widths)))}"))
    if ntotal and sample_size:
        ids = sample_ids(table, ntotal, min(sample_size, ntotal))
        sample = table.join(F.broadcast(ids), "vec_id").select("vec_id", vector.alias(column))
        ok = F.octet_length("code") == dims // 8 if bits else is_valid(F.col("embedding"), dims)
        rows = sample.withColumn("ok", ok).orderBy("vec_id").collect()
        names = ",".join(str(r.vec_id) for r in rows)
        checks.append((SAMPLE, all(r.ok for r in rows), f"sampleIds={names}"))
        found = False
        if rows[0].ok:
            kind = "binary" if bits else "array<double>"
            query = spark.createDataFrame([(rows[0].vec_id, rows[0][column])], f"query_id long, {column} {kind}")
            base = table.select("vec_id", vector.alias(column))
            hits = hamming_knn(base, query, 1, dims=dims) if bits else knn(base, query, 1, metric=metric, dims=dims)
            found = not hits.isEmpty()
        checks.append((SELF, found, "a sampled vector has a nearest row" if found else "a sampled vector has no nearest row"))
    return spark.createDataFrame(checks, "check string, passed boolean, message string")
