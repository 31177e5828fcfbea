"""Settings of the question-generation engine; the driver turns them into literals of the plans."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

#: Labels that never take part in questions.
BLACKLIST = (
    "wall", "floor", "ceiling", "room", "door", "window", "carpet", "rug", "chandelier", "ceiling lamp", "spotlight", "lamp", "light",
    "downlights", "wall lamp", "table lamp", "strip light", "track light", "linear lamp", "decorative pendant", "other", "curtain", "unknown",
    "book", "boxed food", "bagged food", "medicine box", "vegetable", "fruit", "drinks", "canned food", "pen", "medicine bottle", "toiletries",
    "chocolate", "paper", "bread", "cigar", "wine", "fresh food",
)
#: Question types in order of emission.
SINGLE_TYPES = ("object_size", "object_distance_to_camera")
PAIR_TYPES = ("object_size_comparison_relative", "object_size_comparison_absolute", "object_pair_distance_center", "object_pair_distance_center_w_size", "object_pair_distance_vector", "relative_size", "relative_distance_to_camera")
MULTI_TYPES = ("object_comparison_absolute_distance", "object_comparison_relative_distance", "relative_distance")
QUESTION_TYPES = (*SINGLE_TYPES, *PAIR_TYPES, *MULTI_TYPES, "mc")
#: Camera pattern, cameras per item, linear sub-pattern.
PATTERNS = (("around", 3, None), ("spherical", 3, None), ("linear", 3, "approach"), ("rotation", 2, None))


@dataclass
class Selection:
    blacklist: tuple[str, ...] = BLACKLIST
    enable_dim_filter: bool = False
    enable_volume_filter: bool = False
    enable_aspect_ratio_filter: bool = False
    min_dim_component: float = 0.1
    max_dim_component: float = 3.0
    min_volume: float = 0.01
    min_aspect_ratio: float = 0.05
    min_pair_dist: float = 0.3
    max_pair_dist: float = 5.0
    max_pair_dim_ratio: float = 3.0
    max_pair_dim_diff: float = 2.5
    dyn_min_mult: float = 0.2
    dyn_max_mult: float = 2.0


@dataclass
class Cameras:
    """per_angle, spherical_samples, min_visibility_ratio, max_occlusion_ratio and linear_fov_margin are accepted and have no effect."""

    num_cameras_per_item: int = 3
    move_pattern: str = "around"
    per_angle: int = 36
    max_tries: int = 300
    spherical_samples: int = 30
    max_camera_height: float = 1.8
    min_camera_height: float = 0.8
    camera_height_offset: float = 0.2
    min_distance: float = 0.5
    max_distance: float = 4.0
    min_visibility_ratio: float = 0.05
    max_occlusion_ratio: float = 0.6
    min_visible_corners: int = 2
    skip_occlusion_check: bool = False
    check_wall_occlusion: bool = True
    image_width: int = 512
    image_height: int = 512
    fov_deg: float = 60.0
    rotation_interval: float = 5.0
    rotation_camera_height: float = 1.5
    linear_sub_pattern: str = "approach"
    linear_num_steps: int = 5
    linear_fov_margin: float = 0.1
    linear_move_distance: float = 0.3


@dataclass
class Questions:
    enabled_question_types: tuple[str, ...] = QUESTION_TYPES
    dimensions: tuple[str, ...] = ("length", "width", "height")
    max_questions_per_type: int = 5


@dataclass
class Render:
    enable_rendering: bool = True
    gs_root: str = ""
    render_backend: str = "local"
    client_url: str | None = None
    image_width: int = 640
    image_height: int = 480
    fov_deg: float = 60.0
    gpu_device: int | None = None


@dataclass
class Pipeline:
    scenes_root: str = ""
    output_dir: str = ""
    experiment_name: str = "default"
    scene_list: list[str] | None = None
    object_selection: Selection = field(default_factory=Selection)
    camera_sampling: Cameras = field(default_factory=Cameras)
    question_config: Questions = field(default_factory=Questions)
    render_config: Render = field(default_factory=Render)
    save_intermediate: bool = True
    max_questions_per_scene: int = 1000
    min_views_required: int = 0

    @classmethod
    def from_dict(cls, given: dict[str, Any]) -> Pipeline:
        """From nested dicts; the given dict is left as it is."""
        parts = {"object_selection": Selection, "camera_sampling": Cameras, "question_config": Questions, "render_config": Render}
        return cls(**{k: parts[k](**v) if k in parts and isinstance(v, dict) else v for k, v in given.items()})

    def to_dict(self) -> dict[str, Any]:
        """Plain dicts, sets and tuples as lists."""
        plain = lambda x: {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else [plain(v) for v in x] if isinstance(x, list | tuple | set | frozenset) else x
        return plain(dataclasses.asdict(self))

    def validate(self) -> bool:
        for name in ("scenes_root", "output_dir"):
            if not getattr(self, name):
                raise ValueError(f"{name} must be given")
        if "://" not in self.scenes_root and not Path(self.scenes_root).exists():
            raise ValueError(f"no folder {self.scenes_root}")
        return True


#: What the main batch run sets apart from the defaults.
MAIN_CAMERAS = Cameras(max_tries=100, skip_occlusion_check=True, rotation_interval=30.0)
MAIN_QUESTIONS = Questions(max_questions_per_type=10)
MAX_FOCUS_OBJECTS, MIN_FOCUS_OBJECTS, MAX_ROTATION_POSES = 5, 3, 6
