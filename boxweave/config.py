"""Fixed values of the curation rules and the parameter objects built from them."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: class list, id = position ---
CLASS_NAMES = (
    "Person",
    "Vehicle",
    "Motorcycle",
    "Pole",
    "Animals",
    "Stairs",
    "Shelf",
    "Doors",
    "Chairs",
    "Tables",
    "Tricycle",
    "Potholes",
    "Trash Bins",
    "Elevator",
    "Pedestrian Lane",
    "Bicycle",
)
DEFAULT_CAP = 4500
INSTANCE_TARGET = 10000
SEED = 42

# --- Fixed values: source statuses, listing and quota rules ---
INACTIVE_STATUSES = ("failed", "benched", "blocked")
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "webp")
PULL_BUFFER = 1.35
PULL_SPLITS = ("train", "validation", "test")
PROJECT_PREFIX = "roboflow_"

# --- Fixed values: audit thresholds ---
AUDIT_EPSILON = 1e-4
TINY_AREA = 1e-4
FENCE_MIN_BOXES = 20
FENCE_FACTOR = 1.5
FLAG_SAMPLE = 300
ONE_SIDED_SAMPLE = 20
EXCLUDED_SAMPLE = 50

# --- Fixed values: duplicates and split ---
NEAR_THRESHOLD = 0.2
NEAR_SAMPLE = 6000
SPLIT_NAMES = ("train", "val", "test")
TRAIN_RATIO = 0.70
VAL_RATIO = 0.15

# --- Fixed values: scoring and review ---
PROXY_CLASSES = {
    "Person": ("person",),
    "Vehicle": ("car", "bus", "truck"),
    "Motorcycle": ("motorcycle",),
    "Bicycle": ("bicycle",),
    "Animals": ("dog", "cat"),
    "Chairs": ("chair",),
    "Tables": ("dining table",),
}
MATCH_IOU = 0.5
REVIEW_TOP_N = 1000
AUTO_ACCEPT = 0.7

# --- Fixed values: low-light native names ---
LOWLIGHT_CLASSES = {
    "People": "person",
    "Car": "vehicle",
    "Motorbike": "motorcycle",
    "Bicycle": "bicycle",
    "Dog": "animals",
    "Cat": "animals",
    "Chair": "chairs",
    "Table": "tables",
}

# --- Fixed values: ordered priority sources per class, and instance sub-budgets at DEFAULT_CAP ---
DEFAULT_PRIORITY = ("exdark",)
PRIORITY_SOURCES = {
    "Person": ("exdark", "roboflow_revised_pedestrian_obstacle", "crowdhuman", "open_images"),
    "Vehicle": (
        "roboflow_dlsu_d_vehicle_type_detection",
        "exdark",
        "roboflow_revised_pedestrian_obstacle",
        "open_images",
    ),
    "Motorcycle": ("roboflow_dlsu_d_vehicle_type_detection", "exdark", "open_images"),
    "Elevator": ("roboflow_elevator_awvus",),
}
INSTANCE_SUBBUDGETS = {("Person", "crowdhuman"): 2500}


def class_key(name: str) -> str:
    return name.lower().replace(" ", "_")


def proxy_class_ids() -> list[int]:
    return [i for i, name in enumerate(CLASS_NAMES) if name in PROXY_CLASSES]


@dataclass(frozen=True)
class CapPolicy:
    """Budgets of one capping run. ``priority`` and ``subbudgets`` are keyed by class id."""

    hard_cap: int = DEFAULT_CAP
    instance_target: int = INSTANCE_TARGET
    seed: int = SEED
    default_priority: tuple[str, ...] = DEFAULT_PRIORITY
    priority: dict[int, tuple[str, ...]] = field(
        default_factory=lambda: {CLASS_NAMES.index(k): v for k, v in PRIORITY_SOURCES.items()}
    )
    subbudgets: dict[tuple[int, str], int] = field(
        default_factory=lambda: {(CLASS_NAMES.index(c), s): v for (c, s), v in INSTANCE_SUBBUDGETS.items()}
    )

    def __post_init__(self) -> None:
        if self.hard_cap <= 0:
            raise ValueError("hard_cap must be a positive integer")

    def lanes(self) -> list[tuple[int, str, int, int, int | None]]:
        """(class_id, source, position, queued after it, sub-budget at DEFAULT_CAP) rows."""
        rows = []
        for class_id in range(len(CLASS_NAMES)):
            sources = self.priority.get(class_id, self.default_priority)
            for position, source in enumerate(sources, start=1):
                rows.append(
                    (class_id, source, position, len(sources) - position, self.subbudgets.get((class_id, source)))
                )
        return rows
