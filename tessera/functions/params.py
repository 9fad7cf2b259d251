"""Run parameters: enumerations, coercions and the rules between them."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

#: Words read as true and false, backend names, output types and formats.
SWITCHES = {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False, "": False}
BACKENDS = {"": "cpu_blocked", "none": "cpu_blocked", "gpu": "gpu", "cuda": "gpu", "cpu": "cpu_blocked", "cpu_block": "cpu_blocked", "cpu_blocked": "cpu_blocked"}
GEOMETRIES = ("top_view", "affine")
OUTPUT_TYPES = {"uint16": (0, 65535), "float32": None}
ARITHMETIC = ("float64", "float32")
EXPORT_FORMATS = ("tiff", "ozx")
UNSET_WORDS = ("", "-1", "-1.0")
PYRAMID_FACTORS = (1, 2, 4, 8, 16)


def _word(value: Any) -> str:
    return str(value).strip().lower()


def as_bool(value: Any) -> bool:
    """What the word for it means; a value that is no such word counts by its truth."""
    return SWITCHES.get(_word(value), bool(value))


def backend(value: Any) -> str:
    """The backend that a name stands for, hyphens and underscores alike; none is the blocked one."""
    try:
        return BACKENDS["_".join(_word(value).split("-"))]
    except KeyError:
        raise ValueError(f"backend must be one of {sorted(filter(None, BACKENDS))}, not {value!r}") from None


def supplied(value: Any) -> bool:
    """False for null, blank and -1 in any spelling."""
    return value is not None and str(value).strip() not in UNSET_WORDS


def index_triple(value: Any, non_negative: bool = False) -> tuple[int, int, int]:
    """Three whole numbers from text ``a,b,c`` or a list; blank means 0,0,0."""
    if value is None or (isinstance(value, str) and not value):
        return 0, 0, 0
    parts = [int(p) for p in value] if isinstance(value, (list, tuple)) else [int(p) for p in str(value).split(",") if p.strip()]
    if len(parts) != 3 or (non_negative and min(parts) < 0):
        raise ValueError(f"three {'non-negative ' if non_negative else ''}whole numbers are needed, not {value!r}")
    return parts[0], parts[1], parts[2]


@dataclass(frozen=True)
class RunParams:
    """Parameters of one run with the defaults of the batch workflow."""

    dx: float
    dz: float
    angle: float = 40.0
    flip: int = 1
    geometry: str = "top_view"
    backend: str = "cpu_blocked"
    output_type: str = "uint16"
    affine_rotate: Any = True
    pyramid_max: int = 16
    export_formats: tuple[str, ...] = field(default=("ozx",))
    arithmetic: str = "float64"

    def __post_init__(self) -> None:
        for name in ("dx", "dz"):
            if not supplied(getattr(self, name)) or float(getattr(self, name)) <= 0:
                raise ValueError(f"{name} must be given and above 0")
        if self.geometry not in GEOMETRIES:
            raise ValueError(f"geometry must be one of {GEOMETRIES}")
        if self.output_type not in OUTPUT_TYPES:
            raise ValueError(f"output type must be one of {tuple(OUTPUT_TYPES)}")
        if self.output_type == "float32" and self.geometry != "affine":
            raise ValueError("float32 output needs the affine geometry")
        if self.arithmetic not in ARITHMETIC:
            raise ValueError(f"arithmetic must be one of {ARITHMETIC}")
        if self.pyramid_max not in PYRAMID_FACTORS:
            raise ValueError(f"pyramid_max must be one of {PYRAMID_FACTORS}")
        if bad := [f for f in self.export_formats if f.lower() not in EXPORT_FORMATS]:
            raise ValueError(f"unknown export formats {bad}")
        object.__setattr__(self, "backend", backend(self.backend))
        object.__setattr__(self, "affine_rotate", as_bool(self.affine_rotate))

    @property
    def rounding(self) -> str:
        """Half-up where the accelerated path rounds so; else half-even."""
        return "half_up" if self.backend == "gpu" or self.geometry == "affine" else "half_even"
