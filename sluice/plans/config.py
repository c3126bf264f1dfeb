"""Settings and the registry of sources: YAML with environment overrides."""

from __future__ import annotations

import json
import logging
import os
from dataclasses import dataclass, field
from typing import Any

# Settings where the file has none.
DEFAULTS: dict[str, Any] = {
    "concurrency": 25, "per_host": 5, "timeout_seconds": 20, "max_retries": 4, "chunk_tokens": 6000, "chunk_overlap": 200,
    "fuzzy_threshold": 97, "review_threshold": 80, "fresh_hours": 24, "target": 1000,
}


@dataclass(frozen=True)
class Settings:
    values: dict[str, Any] = field(default_factory=dict)
    sources: dict[str, list[dict[str, Any]]] = field(default_factory=dict)

    def __getitem__(self, name: str) -> Any:
        return self.values[name]

    def source_group(self, name: str) -> list[dict[str, Any]]:
        """The enabled sources of a group; a group that is not there is empty."""
        return [s for s in self.sources.get(name, []) if s.get("enabled", True)]


def _read(path: str | None) -> dict:
    if not path or not os.path.exists(path):
        return {}
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def load(settings: str | None = None, sources: str | None = None, env: dict[str, str] | None = None, prefix: str = "SLUICE_") -> Settings:
    """Defaults, then the file, then variables of the prefix; a variable's value is JSON where it can be."""
    values = DEFAULTS | _read(settings)
    for name, text in (os.environ if env is None else env).items():
        if name.startswith(prefix):
            try:
                values[name.removeprefix(prefix).lower()] = json.loads(text)
            except ValueError:
                values[name.removeprefix(prefix).lower()] = text
    return Settings(values, _read(sources))


def pick(registry: dict[str, Any], sources: list[dict[str, Any]], key: str = "adapter") -> list[tuple[dict[str, Any], Any]]:
    """(source, adapter) of the sources whose adapter is known; the others are warned of and passed over."""
    out = []
    for s in sources:
        if s.get(key) in registry:
            out.append((s, registry[s[key]]))
        else:
            logging.getLogger("sluice").warning("unknown adapter %s of source %s", s.get(key), s.get("name"))
    return out


class JsonFormatter(logging.Formatter):
    """Log records as JSON lines."""

    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"level": record.levelname.lower(), "logger": record.name, "event": record.getMessage(), "time": self.formatTime(record)}, ensure_ascii=False)
