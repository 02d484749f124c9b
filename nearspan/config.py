"""Validated index settings."""

from __future__ import annotations

from dataclasses import dataclass, fields

from nearspan.errors import ConfigError, DimensionError
from nearspan.operators.quantize import scalar_bits

# fixed values: the kinds a user may name
FLOAT_KINDS = ("FLAT_L2", "FLAT_IP", "IVF_FLAT", "HNSW", "PQ", "IVF_PQ", "IVF_SQ", "SQ")
BIT_KINDS = ("BINARY_FLAT", "BINARY_IVF", "BINARY_HNSW", "BINARY_HASH")
REDUCTIONS = ("PCA", "PCAR", "OPQ")

# which options belong to which kinds
_OWNERS = {
    "nlist": {"IVF_FLAT", "IVF_PQ", "IVF_SQ", "BINARY_IVF"},
    "nprobe": {"IVF_FLAT", "IVF_PQ", "IVF_SQ", "BINARY_IVF"},
    "degree": {"HNSW", "BINARY_HNSW"},
    "ef_construction": {"HNSW", "BINARY_HNSW"},
    "ef_search": {"HNSW", "BINARY_HNSW"},
    "pq_segments": {"PQ", "IVF_PQ"},
    "pq_bits": {"PQ", "IVF_PQ"},
    "sq_type": {"SQ", "IVF_SQ"},
    "hash_bits": {"BINARY_HASH"},
    "hash_nflip": {"BINARY_HASH"},
    "hash_tables": {"BINARY_HASH"},
}

# fixed values: defaults when an option is not given
_DEFAULTS = {
    "nlist": 100, "nprobe": 10, "degree": 16, "ef_construction": 200, "ef_search": 50,
    "pq_segments": 8, "pq_bits": 8, "sq_type": "SQ8", "hash_bits": 64, "hash_nflip": 0, "hash_tables": 1,
}
_BIT_DEFAULTS = {**_DEFAULTS, "degree": 32}


@dataclass(frozen=True)
class IndexConfig:
    """Settings of one index. An option that the kind does not use must stay None.

    ``reduction`` (PCA, PCAR or OPQ) puts a linear transform to ``reduced_dims`` in front of any float
    kind; the kind then works on the reduced vectors.
    """

    dims: int
    kind: str = "FLAT_L2"
    metric: str | None = None
    nlist: int | None = None
    nprobe: int | None = None
    degree: int | None = None
    ef_construction: int | None = None
    ef_search: int | None = None
    pq_segments: int | None = None
    pq_bits: int | None = None
    sq_type: str | None = None
    hash_bits: int | None = None
    hash_nflip: int | None = None
    hash_tables: int | None = None
    reduction: str | None = None
    reduced_dims: int | None = None
    train_rounds: int = 10

    def __post_init__(self) -> None:
        _positive("dims", self.dims)
        _positive("train_rounds", self.train_rounds)
        if self.kind not in FLOAT_KINDS + BIT_KINDS:
            raise ConfigError(f"kind {self.kind!r} not supported; use one of {', '.join(FLOAT_KINDS + BIT_KINDS)}")
        self._check_metric()
        for f in fields(self):
            value = getattr(self, f.name)
            if f.name in _OWNERS and value is not None:
                if self.kind not in _OWNERS[f.name]:
                    raise ConfigError(f"{f.name} is only for {', '.join(sorted(_OWNERS[f.name]))}")
                if f.name == "hash_nflip":
                    _non_negative(f.name, value)
                elif f.name != "sq_type":
                    _positive(f.name, value)
        if self.sq_type is not None:
            scalar_bits(self.sq_type)
        if self.is_bits and self.dims % 8:
            raise ConfigError("bit dims must be divisible by 8")
        self._check_reduction()
        if "PQ" in self.kind and self.work_dims % self.option("pq_segments"):
            raise DimensionError(f"{self.work_dims} components cannot be cut into {self.option('pq_segments')} "
                                 "segments of one width (pq_segments)")

    def _check_metric(self) -> None:
        if self.metric is None:
            return
        if self.is_bits or self.metric not in ("l2", "ip"):
            raise ConfigError("metric must be l2 or ip, and is fixed for bit kinds")
        if (self.kind, self.metric) in (("FLAT_L2", "ip"), ("FLAT_IP", "l2")):
            raise ConfigError(f"{self.kind} does not support metric {self.metric}")

    def _check_reduction(self) -> None:
        if self.reduction is None:
            if self.reduced_dims is not None:
                raise ConfigError("reduced_dims needs a reduction")
            return
        if self.reduction not in REDUCTIONS or self.is_bits:
            raise ConfigError(f"reduction must be one of {', '.join(REDUCTIONS)}, on a float kind")
        if self.reduction == "OPQ" and "PQ" not in self.kind:
            raise ConfigError("OPQ goes in front of PQ or IVF_PQ")
        if self.reduced_dims is not None:
            _positive("reduced_dims", self.reduced_dims)
            if self.reduced_dims > self.dims:
                raise DimensionError("reduced_dims must not exceed dims")

    @property
    def is_bits(self) -> bool:
        return self.kind in BIT_KINDS

    @property
    def work_dims(self) -> int:
        """Width after the reduction."""
        return self.reduced_dims or self.dims

    @property
    def work_metric(self) -> str:
        if self.is_bits:
            return "hamming"
        return "ip" if self.kind == "FLAT_IP" else self.metric or "l2"

    @property
    def needs_training(self) -> bool:
        return self.reduction is not None or "IVF" in self.kind or "PQ" in self.kind or "SQ" in self.kind

    def option(self, name: str):
        """The given value, or the default."""
        value = getattr(self, name)
        return (_BIT_DEFAULTS if self.is_bits else _DEFAULTS)[name] if value is None else value

    @property
    def label(self) -> str:
        """Short description of the stages."""
        stages = []
        if self.reduction:
            stages.append(f"{self.reduction}{self.work_dims}")
        stages.append(self.kind)
        return ",".join(stages)


def _positive(name: str, value) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ConfigError(f"{name} must be a positive integer")


def _non_negative(name: str, value) -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise ConfigError(f"{name} must be a non-negative integer")
