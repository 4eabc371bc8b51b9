"""Settings of a run: defaults, a JSON or YAML file, overrides; checked as a whole."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path

#: The words that settings files use.
ENGINES = ("tesseract", "paddleocr", "easyocr")
LAYOUTS = ("tesseract", "none")
TABLES = ("cv", "none")
OUTPUTS = ("markdown", "coco")
STEPS = ("orientation", "deskew", "denoise", "grayscale", "binarize")
FOLDERS = ("input_dir", "output_dir", "review_dir", "artifacts_dir", "ground_truth_dir")


class ConfigError(ValueError):
    """Settings that can't be used."""


@dataclass(frozen=True)
class Config:
    engine: str = "tesseract"
    langs: tuple[str, ...] = ("vie",)
    dpi: int = 300
    preprocess_steps: tuple[str, ...] = ("orientation", "deskew", "denoise")
    layout: str = "tesseract"
    table: str = "cv"
    outputs: tuple[str, ...] = ("markdown",)
    qa_threshold: float = 0.75
    input_dir: str = "data/input"
    output_dir: str = "data/output"
    review_dir: str = "data/review"
    artifacts_dir: str = "data/artifacts"
    ground_truth_dir: str = "data/ground_truth"

    def __post_init__(self) -> None:
        for name, value, known in (("engine", (self.engine,), ENGINES), ("layout", (self.layout,), LAYOUTS), ("table", (self.table,), TABLES), ("outputs", self.outputs, OUTPUTS), ("preprocess_steps", self.preprocess_steps, STEPS)):
            if unknown := [v for v in value if v not in known]:
                raise ConfigError(f"{name}: {unknown[0]!r} is none of {', '.join(known)}")
        if not self.langs or not all(isinstance(x, str) and x for x in self.langs):
            raise ConfigError("langs: a list of names is needed")
        if self.layout == "tesseract" and self.engine != "tesseract":
            raise ConfigError("layout: only the engine tesseract reports the blocks that the layout tesseract needs")
        if not 0 <= self.qa_threshold <= 1:
            raise ConfigError("qa_threshold: a number from 0 to 1 is needed")

    def version(self) -> str:
        """What results depend on, folders left out: names and 8 digits of a hash."""
        own = {k: v for k, v in asdict(self).items() if k not in FOLDERS}
        digest = hashlib.sha256(json.dumps(own, sort_keys=True).encode()).hexdigest()[:8]
        return f"{self.engine}_{'+'.join(self.langs)}_{self.layout}_{self.table}_{digest}"


def _read(path: Path) -> dict:
    text = path.read_text(encoding="utf-8")
    try:
        found = json.loads(text)
    except ValueError:
        import yaml

        found = yaml.safe_load(text)
    if found is not None and not isinstance(found, dict):
        raise ConfigError(f"{path}: a mapping is needed")
    return found or {}


def load_config(path: str | Path | None = None, **overrides) -> Config:
    """Defaults under the file's values under overrides; None means not given, an unknown key is an error."""
    known = {f.name for f in fields(Config)}
    given: dict = {}
    for layer in (_read(Path(path)) if path else {}, overrides):
        if unknown := sorted(set(layer) - known):
            raise ConfigError(f"unknown key {unknown[0]!r}")
        given |= {k: tuple(v) if isinstance(v, list) else v for k, v in layer.items() if v is not None}
    return replace(Config(), **given)


def run_config(path: str | Path | None = None, default: str | Path = "config.yaml", out: str | None = None) -> Config:
    """The settings of a command: of a file that is named, else of the default file if there is one; `out` replaces output_dir."""
    chosen = path or (default if Path(default).is_file() else None)
    return load_config(chosen, output_dir=out)


def evaluation_dirs(pred_dir: str | None, gt_dir: str | None, base: str | Path, settings: dict | None = None) -> tuple[Path, Path]:
    """Folders of predictions and gold: as given, else from settings relative to base; a missing one is an error."""
    out = []
    for name, given in (("pred_dir", pred_dir), ("gt_dir", gt_dir)):
        path = Path(given) if given else Path(base) / (settings or {}).get(name, f"data/{name}")
        if not path.is_dir():
            raise ConfigError(f"{name}: {path} isn't a folder")
        out.append(path)
    return out[0], out[1]
