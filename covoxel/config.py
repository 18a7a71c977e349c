"""Settings, validated once on the driver."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field
from hashlib import sha256
from statistics import NormalDist

Threshold = int | Mapping[float, int]

# Fixed limits of the candidate search.
MAX_PAIRS_FOR_SETS, MAX_ITEMS_FOR_K4, MAX_SETS = 5000, 50, 10_000
#: Channels per bit word of a voxel's signature.
WORD_BITS = 62


@dataclass(frozen=True)
class VoxelSize:
    """Micrometres per voxel."""

    x: float = 0.14
    y: float = 0.14
    z: float = 0.28

    @property
    def volume(self) -> float:
        return self.x * self.y * self.z


@dataclass(frozen=True)
class EngineConfig:
    """What the tile analysis depends on. Thresholds are one number, or one for each radius (a missing one is 0)."""

    channels: tuple[int, ...] = ()
    tile_xy: tuple[int, int] = (128, 128)  # y, x
    alpha: float = 0.4
    trim_q: float = 0.98
    voxel_size: VoxelSize = field(default_factory=VoxelSize)
    min_obj_vol_um3: float = 1.0
    connectivity: int = 26
    dilate_um: tuple[float, ...] = (0.0, 1.0, 2.0, 3.0)
    max_set_size: int = 4
    min_marker_vox: Threshold = 1000
    min_support_pair: Threshold = 100
    min_support_set: Threshold = 50
    aggressive_stop_on_fail: bool = True
    hierarchy_levels: int = 4

    def __post_init__(self) -> None:
        radii = [float(r) for r in self.dilate_um]
        if not radii or len(set(radii)) != len(radii) or min(radii) < 0:
            raise ValueError("dilate_um: one or more distinct radii, none negative")
        if self.connectivity not in (6, 26):
            raise ValueError("connectivity: 6 or 26")
        if not 0 < self.alpha < 1 or not 0 < self.trim_q <= 1:
            raise ValueError("alpha and trim_q lie between 0 and 1")
        if min(self.tile_xy) < 1 or self.hierarchy_levels < 1 or min(self.voxel_size.x, self.voxel_size.y, self.voxel_size.z) <= 0:
            raise ValueError("tile sizes, voxel sizes and levels are positive")
        if len(set(self.channels)) != len(self.channels):
            raise ValueError("channels repeat")
        object.__setattr__(self, "dilate_um", tuple(sorted(radii)))

    @property
    def tile_y(self) -> int:
        return self.tile_xy[0]

    @property
    def tile_x(self) -> int:
        return self.tile_xy[1]

    @property
    def min_voxels(self) -> int:
        return math.ceil(self.min_obj_vol_um3 / self.voxel_size.volume)

    @property
    def z_alpha(self) -> float:
        return NormalDist().inv_cdf(1 - self.alpha)

    @staticmethod
    def at(spec: Threshold, r: float) -> int:
        return spec if isinstance(spec, int) else spec.get(r, 0)

    def fingerprint(self) -> str:
        """What a checkpoint must share with the run that resumes from it."""
        return sha256(repr(self).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class FilterConfig:
    """Which combinations survive; applied at the largest radius unless filter_by_max_dilation is off."""

    min_overlap_coeff: float = 0.0
    min_inter_vox: int = 0
    filter_by_max_dilation: bool = True
    min_tiles_present: int = 1
    top_k_percent: float | None = None
    min_set_size: int = 2
    max_set_size: int = 10
    strict: bool = False  # also drop, at other radii, what fails at the largest one

    def __post_init__(self) -> None:
        if self.top_k_percent is not None and not 0 < self.top_k_percent <= 1:
            raise ValueError("top_k_percent lies between 0 and 1")
