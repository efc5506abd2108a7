"""Settings of the pipeline; every value can be overridden with dataclasses.replace."""

from __future__ import annotations

from dataclasses import dataclass

# The model's class labels, in the order of their ids.
CLASS_NAMES = (
    "plane", "ship", "storage tank", "baseball diamond", "tennis court",
    "basketball court", "ground track field", "harbor", "bridge", "large vehicle",
    "small vehicle", "helicopter", "roundabout", "soccer ball field", "swimming pool",
)


@dataclass(frozen=True)
class Config:
    input_size: int = 512
    display_confidence: float = 0.25
    floor_confidence: float = 0.05
    single_pass_limit: int = 1280
    tile_overlap: float = 0.25
    nms_iou: float = 0.45
    merge_iou: float = 0.5
    pad_grey: int = 114
    class_names: tuple[str, ...] = CLASS_NAMES


DEFAULT = Config()
