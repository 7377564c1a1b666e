"""Typed settings read from JSON files: every value is checked before any job runs."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from pathlib import Path
from typing import Any, TypeVar, get_type_hints

S = TypeVar("S")


def limits(least: float | None = None, most: float | None = None, above: float | None = None, below: float | None = None) -> dict[str, float | None]:
    """Bounds of a number: ``least`` and ``most`` count as inside, ``above`` and ``below`` do not."""
    return {"least": least, "most": most, "above": above, "below": below}


@dataclass(frozen=True)
class SplitSettings:
    """How a corpus is split."""

    train: float = 0.8
    validation: float = 0.1
    test: float = 0.1
    seed: int = 42

    LIMITS = {"train": limits(above=0, below=1), "validation": limits(above=0, below=1), "test": limits(above=0, below=1), "seed": limits(least=0)}

    def check(self) -> None:
        if abs(self.train + self.validation + self.test - 1) > 1e-9:
            raise ValueError("train, validation and test must add up to 1")


@dataclass(frozen=True)
class MetricSettings:
    """How translations are scored."""

    bleu_order: int = 4
    bleu_smoothing: float = 0.1
    tokenization: str = "whitespace"
    chrf_order: int = 6
    chrf_beta: float = 2.0
    sample: int = 200

    LIMITS = {"bleu_order": limits(least=1), "bleu_smoothing": limits(above=0), "chrf_order": limits(least=1), "chrf_beta": limits(above=0), "sample": limits(least=1)}

    def check(self) -> None:
        if self.tokenization not in ("whitespace", "char"):
            raise ValueError(f"tokenization: {self.tokenization}")


@dataclass(frozen=True)
class DecodingSettings:
    """How a model translates."""

    max_source: int = 256
    max_new: int = 256
    beams: int = 4
    length_penalty: float = 1.0
    batch: int = 32

    LIMITS = {"max_source": limits(least=1), "max_new": limits(least=1), "beams": limits(least=1), "length_penalty": limits(above=0), "batch": limits(least=1)}


@dataclass(frozen=True)
class ServiceSettings:
    """What a request may hold."""

    most_items: int = 32
    longest_text: int = 2000
    timeout_seconds: float = 30.0
    at_once: int = 1

    LIMITS = {"most_items": limits(least=1), "longest_text": limits(least=1), "timeout_seconds": limits(above=0), "at_once": limits(least=1)}


@dataclass(frozen=True)
class CleanupSettings:
    """How rows go to a model in batches."""

    batch_rows: int = 25
    model: str = "model"
    temperature: float = 0.0
    output_tokens: int = 4096
    attempts: int = 3
    sample: int = 200

    LIMITS = {"batch_rows": limits(least=1), "temperature": limits(least=0, most=2), "output_tokens": limits(least=1), "attempts": limits(least=1), "sample": limits(least=0)}


def make(kind: type[S], values: dict[str, Any]) -> S:
    """Settings from a mapping: unknown names, wrong types and values out of bounds are errors."""
    known = {f.name for f in fields(kind)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    hints = get_type_hints(kind)
    for name, value in values.items():
        wanted = hints[name]
        fits = isinstance(value, (int, float)) and not isinstance(value, bool) if wanted is float else isinstance(value, wanted) and not (wanted is int and isinstance(value, bool))
        if not fits:
            raise ValueError(f"{name} must be {wanted.__name__}")
    made = kind(**values)
    for name, bound in getattr(kind, "LIMITS", {}).items():
        value = getattr(made, name)
        out = (
            bound["least"] is not None and value < bound["least"] or bound["most"] is not None and value > bound["most"]
            or bound["above"] is not None and value <= bound["above"] or bound["below"] is not None and value >= bound["below"]
        )
        if out:
            raise ValueError(f"{name} is out of bounds: {value}")
    if hasattr(made, "check"):
        made.check()
    return made


def read_settings(kind: type[S], path: str, section: str | None = None) -> S:
    """Settings of a JSON file, or of one section of it."""
    values = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    values = values.get(section) if section and isinstance(values, dict) else values
    if not isinstance(values, dict):
        raise ValueError(f"{path}: no object" + (f" {section}" if section else ""))
    return make(kind, values)
