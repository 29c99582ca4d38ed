"""Configuration and prompts: small files that the driver reads. Thresholds become literals of the plans."""

from __future__ import annotations

import hashlib
import importlib
import json
from dataclasses import asdict, dataclass, field
from decimal import Decimal
from pathlib import Path

THRESHOLDS = ("noncritical_recognition_accept", "critical_recognition_accept", "recognition_fallback_floor", "split_accept", "answer_match_accept", "answer_match_margin", "answer_verify_accept")
SERVICES = ("text_ocr", "formula_ocr", "table", "vision", "llm")
ROLES = ("primary", "fallback", "verifier")
_SECRET = ("key", "token", "secret", "password", "credential")


class ConfigError(ValueError):
    """The configuration breaks a rule; the message names all rules that it breaks."""


@dataclass(frozen=True)
class Config:
    pipeline_version: str = "0.1.0"
    #: Thresholds as decimal texts, so that edges are exact. Fixed default values.
    quality: dict[str, str] = field(default_factory=lambda: dict(zip(THRESHOLDS, ("0.95", "0.98", "0.90", "0.98", "0.995", "0.10", "0.995"), strict=True)))
    #: service -> role -> "module:factory"; secrets come from the environment of the factory.
    providers: dict[str, dict[str, str]] = field(default_factory=dict)
    concurrency: dict[str, int] = field(default_factory=lambda: {"document_parse": 4, "text_ocr": 8, "formula_ocr": 4, "table": 4, "vision": 4, "llm": 6})
    output: dict[str, str] = field(default_factory=lambda: {"copyright_default": "0", "slim_md5_version": "slim_md5_v1"})

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def _secrets(value, path: str = "") -> list[str]:
    if not isinstance(value, dict):
        return []
    named = [f"{path}{k}: secrets do not belong into a configuration" for k in value if any(str(k).lower().endswith(s) for s in _SECRET)]
    return named + [e for k, v in value.items() for e in _secrets(v, f"{path}{k}.")]


def validated(raw: dict) -> Config:
    """The configuration of a dictionary, with defaults for what it leaves out."""
    errors, base = _secrets(raw), Config()
    errors += [f"{k}: not known" for k in raw if k not in asdict(base)]
    flags = {"precision_first", "reject_on_missing_answer", "reject_on_unresolved_formula", "reject_on_ambiguous_match"}
    quality = dict(raw.get("quality") or {})
    errors += [f"quality.{k}: only true is supported" for k in flags & set(quality) if quality[k] is not True]
    quality = {k: str(v) for k, v in quality.items() if k not in flags}
    errors += [f"quality.{k}: not known" for k in quality if k not in THRESHOLDS]
    quality = {**base.quality, **quality}
    numbers = {}
    for k, v in quality.items():
        try:
            numbers[k] = Decimal(v)
        except ArithmeticError:
            numbers[k] = Decimal(-1)
        if not 0 <= numbers[k] <= 1:
            errors.append(f"quality.{k}: not a number from 0 to 1")
    if numbers["recognition_fallback_floor"] > numbers["critical_recognition_accept"]:
        errors.append("quality.recognition_fallback_floor: above critical_recognition_accept")
    providers = raw.get("providers") or {}
    errors += [f"providers.{s}: not known" for s in providers if s not in SERVICES]
    errors += [f"providers.{s}.{r}: not known" for s, roles in providers.items() for r in roles if r not in ROLES]
    concurrency = {**base.concurrency, **(raw.get("concurrency") or {})}
    errors += [f"concurrency.{k}: not a positive whole number" for k, v in concurrency.items() if not isinstance(v, int) or isinstance(v, bool) or v < 1]
    if errors:
        raise ConfigError("; ".join(errors))
    return Config(str(raw.get("pipeline_version", base.pipeline_version)), quality, providers, concurrency, {**base.output, **(raw.get("output") or {})})


def load(path: str | None) -> Config:
    """The configuration of a YAML file (JSON is YAML too); without a path the defaults."""
    if path is None:
        return Config()
    import yaml

    try:
        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ConfigError(f"not YAML: {error}") from error
    if not isinstance(raw or {}, dict):
        raise ConfigError("not a mapping")
    return validated(raw or {})


def provider(config: Config, service: str, role: str):
    """The provider that a configuration names for a role, or None."""
    name = (config.providers.get(service) or {}).get(role)
    if name is None:
        return None
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)()


def prompt(task: str, version: str = "v1") -> str:
    return (Path(__file__).resolve().parents[1] / "prompts" / task / f"{version}.txt").read_text(encoding="utf-8").strip()
