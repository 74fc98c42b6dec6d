"""All settings of a conversion in one place."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Rows one task may reasonably sort for a single key. A group above it is cut into
# pieces. A table of N rows has at most N / HOT_ROWS such groups, which bounds every
# list of hot groups that is broadcast (100 TB of 40-byte rows: about 600 000 entries).
HOT_ROWS = 4_000_000

# As ``hot_rows``, ``hot_copies`` or ``crowded``: no group can be hot, so none is looked for.
NO_HOT_ROWS = 1 << 62

# Rows per piece of a hot group, without its overlap with the next piece.
SEGMENT_ROWS = 1_000_000

# Pedestrians with one and the same track that are compared with each other one by one.
HOT_COPIES = 1_000

# Rows of a grid cell that are looked at one by one by everybody near it.
CROWDED = 1_000

# Largest lookup table that is broadcast after counting it.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class SceneConfig:
    """Scene cutting, typing and selection settings; the defaults are the usual ones."""

    obs_len: int = 9
    pred_len: int = 12
    train_fraction: float = 0.6
    val_fraction: float = 0.2
    fps: float = 2.5
    order_frames: bool = False
    chunk_stride: int = 2
    min_length: float = 0.0  # compared with the squared end-to-end distance
    cell_size: float = 10.0
    gap_tolerance: float = 1.5
    activity: float = 2.0
    all_present: bool = False
    drop_collisions: bool = False
    distinct_starts: bool = False
    static_threshold: float = 1.0
    linear_threshold: float = 0.5
    inter_dist_thresh: float = 5.0
    inter_pos_range: float = 15.0  # degrees
    grp_dist_thresh: float = 0.8
    grp_std_thresh: float = 0.2
    collision_radius: float = 0.1
    forecast_iterations: int = 5
    require_parts: bool = False  # every recording needs scenes in each of its parts
    acceptance: tuple[float, float, float, float] = (0.1, 1.0, 1.0, 1.0)
    seed: int = 42
    hot_rows: int = HOT_ROWS
    segment_rows: int = SEGMENT_ROWS
    hot_copies: int = HOT_COPIES
    crowded: int = CROWDED

    @property
    def chunk_size(self) -> int:
        return self.obs_len + self.pred_len

    @property
    def has_test(self) -> bool:
        """Whether a test part is left over; a rounding residue is not one."""
        return 1.0 - self.train_fraction - self.val_fraction > 1e-9

    def but(self, **changes) -> SceneConfig:
        return replace(self, **changes)
