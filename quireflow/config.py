"""Typed settings: defaults, a development profile, files and environment variables."""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace

#: Labels that ground truth may carry, those found by rules, and those linked to places. A project's
#: own prefix comes in by Settings.label_prefix.
TAG_LABELS = (
    "Collection",
    "Collector",
    "Determination",
    "ExpeditionProject",
    "GatheringDate",
    "Institution",
    "NURI",
    "Sex",
    "Specimen",
    "Type",
    "GatheringSite",
    "Geo_Area",
    "Geo_Elevation",
    "Geo_Latitude",
    "Geo_Longitude",
    "Geo_Town",
    "Geo_Country",
)
RULE_LABELS = ("GatheringDate", "NURI", "Sex", "Geo_Latitude", "Geo_Longitude", "Type")
GEO_LABELS = ("Geo_Country", "Geo_Area", "Geo_Town")
IMAGE_NAME = r"\.(jpg|jpeg|png|tiff|tif)$"


@dataclass(frozen=True)
class Settings:
    """Defaults of a production run; development() gives the small profile."""

    image_path: str = "data/images"
    output_path: str = "data/out"
    truth_path: str = ""
    max_images: int = 50
    summary_interval: int = 10
    evaluation: bool = False
    debug: bool = False
    max_image_dimension: int = 1920
    steps: tuple[str, ...] = ()  # of gray, smooth, threshold, denoise, contrast
    segmenter: str = "bright-regions"
    least_mask_pixels: int = 100
    least_area_share: float = 0.01
    least_fill: float = 0.9
    closing_kernel: int = 20
    backend: str = "moondream"
    prompt: str = ""  # what a backend that is asked is asked; it has no default
    label_prefix: str = ""
    uri_host: str = "coll.example.org"
    rule_labels: tuple[str, ...] = RULE_LABELS
    tag_labels: tuple[str, ...] = TAG_LABELS
    geo_labels: tuple[str, ...] = GEO_LABELS
    creator: str = "quireflow"

    def development(self) -> Settings:
        return replace(self, max_images=5, evaluation=True, debug=True)

    def labels(self, names: tuple[str, ...]) -> tuple[str, ...]:
        """Labels as they stand in data, with the project's prefix."""
        return tuple(self.label_prefix + n for n in names)

    def updated(self, values: Mapping[str, object]) -> Settings:
        """With values by name (texts are read as the default's type); an unknown name is an error."""
        kinds = {f.name: getattr(self, f.name) for f in fields(self)}
        if unknown := set(values) - set(kinds):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **{k: _read(v, kinds[k]) for k, v in values.items()})


def _read(value: object, like: object) -> object:
    if isinstance(like, tuple):
        return tuple(v.strip() for v in value.split(",") if v.strip()) if isinstance(value, str) else tuple(value)
    if isinstance(like, bool) and isinstance(value, str):
        return value.strip().lower() in ("1", "true", "yes", "on")
    return type(like)(value)


def env_file(path: str) -> dict[str, str]:
    """NAME=value lines; blank lines and comments are left out, quotes around a value removed."""
    out = {}
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            name, eq, value = line.strip().partition("=")
            if eq and not name.startswith("#"):
                out[name.removeprefix("export ").strip()] = value.strip().strip("\"'")
    return out


def load_settings(path: str | None = None, environ: Mapping[str, str] | None = None, prefix: str = "QUIREFLOW_") -> Settings:
    """Defaults, then a JSON or YAML file (given, or named by <prefix>CONFIG), then variables <prefix><NAME>."""
    environ = os.environ if environ is None else environ
    path = path or environ.get(f"{prefix}CONFIG")
    out = Settings()
    if path:
        with open(path, encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                import yaml

                read = yaml.safe_load(f)
            else:
                read = json.load(f)
        out = out.updated(read or {})
    return out.updated({k: environ[v] for k in asdict(out) if (v := prefix + k.upper()) in environ})


def logger(name: str, run_id: str | None = None) -> logging.LoggerAdapter | logging.Logger:
    """A module's log; inside a run each line carries the run's id."""
    log = logging.getLogger(f"quireflow.{name}")
    return logging.LoggerAdapter(log, {"run_id": run_id}, merge_extra=True) if run_id else log
