"""Run parameters and the region layout of an amplicon."""

from __future__ import annotations

from dataclasses import dataclass, field

LINEAR_REGIONS = ("primer", "shared", "wt", "mut")
PCR2_REGIONS = ("fw_wt", "fw_mut", "rv_wt", "rv_mut")
CIRC_REGIONS = LINEAR_REGIONS + PCR2_REGIONS


def allowed_mismatches(length: int, ratio: float) -> int:
    """Round half to even, as the mismatch allowances are defined."""
    return int(round(length * ratio))


@dataclass(frozen=True)
class Region:
    """One expected sequence and its 1-based inclusive position on the read."""

    name: str
    seq: str
    start: int
    end: int

    def __post_init__(self):
        if not self.seq or self.start < 1:
            raise ValueError(f"region {self.name!r} needs a sequence and a start of at least 1")


@dataclass(frozen=True)
class RegionConfig:
    """The four regions of a linear amplicon, or the eight of a circular one."""

    regions: tuple[Region, ...]

    def __post_init__(self):
        names = tuple(r.name for r in self.regions)
        if names not in (LINEAR_REGIONS, CIRC_REGIONS):
            raise ValueError(f"expected regions {LINEAR_REGIONS} or {CIRC_REGIONS}, got {names}")

    @property
    def mode(self) -> str:
        return "circ" if len(self.regions) == len(CIRC_REGIONS) else "linear"

    def __getitem__(self, name: str) -> Region:
        return next(r for r in self.regions if r.name == name)

    def allowance(self, name: str, ratio: float) -> int:
        return allowed_mismatches(len(self[name].seq), ratio)

    def linear(self) -> "RegionConfig":
        """The linear part of a circular layout."""
        return RegionConfig(self.regions[: len(LINEAR_REGIONS)])


@dataclass(frozen=True)
class Params:
    """Thresholds of a genotyping run.

    ``chunk_cols`` names extra key columns (usually ``chunk_id``) that keep priors, duplicate groups and the
    cell cut local to a chunk; empty means one global, deterministic run.
    """

    bc_len: int = 16
    umi_len: int = 12
    mismatch_ratio: float = 0.2
    posterior: float = 0.99
    dupcut: int = 1
    pcr_threshold: float = 0.75
    umi_distance: float = 0.2
    umi_metric: str = "unanchored"
    umi_dupcut: int = 2
    pcr2_ratio: float = 0.0
    max_shift: int = 3
    # A zero prior with two or more candidates reads NO_in_SAVED; set to get Not_Sig for those as well.
    zero_prior_not_sig: bool = False
    chunk_cols: tuple[str, ...] = field(default=())
