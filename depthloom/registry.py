"""Data sets and their products; the one extension point. A product is a function of frames, boxes and a root folder."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from pathlib import Path

from depthloom.plans import lines

DATASETS: dict[str, dict[str, Callable]] = {
    "sunrgbd": {
        "nuscenes": lambda frames, boxes, root, **o: lines.point_clouds(frames, root, **o),
        "occ": lambda frames, boxes, root, **o: lines.occupancy(frames, root, **o),
        "detection": lambda frames, boxes, root, **o: lines.detection_product(frames, boxes, root, **o),
        "2d": lambda frames, boxes, root, **o: lines.boxes_2d(boxes, root, **o),
        "all": lambda frames, boxes, root, **o: lines.run_all(frames, boxes, root, **o),
    }
}


def product(dataset: str, name: str) -> Callable:
    if dataset not in DATASETS:
        raise KeyError(f"no data set {dataset}; there are {', '.join(DATASETS)}")
    if name not in DATASETS[dataset]:
        raise KeyError(f"{dataset} has no product {name}; it has {', '.join(DATASETS[dataset])}")
    return DATASETS[dataset][name]


def dataset_paths(name: str, file: str = "config.json") -> dict[str, str]:
    """Folders of a data set: the file that DEPTHLOOM_CONFIG names, else ``file``."""
    path = Path(os.environ.get("DEPTHLOOM_CONFIG", file))
    held = json.loads(path.read_text()) if path.exists() else {}
    if name not in held:
        raise KeyError(f"{path} has no data set {name}")
    return held[name]
