"""Settings from KEY=VALUE files and the environment; driver side only."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


def parse_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines; blank lines, comments and lines without = are skipped, quotes around values go."""
    out: dict[str, str] = {}
    for line in map(str.strip, text.splitlines()):
        key, found, value = line.partition("=")
        if found and key.strip() and not line.startswith("#") and key.strip() not in out:
            out[key.strip()] = value.strip().strip('"').strip("'")
    return out


def merged(settings: Mapping[str, str], environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """The environment, with the file's values where it has none or an empty one."""
    base = dict(os.environ if environment is None else environment)
    return base | {k: v for k, v in settings.items() if not base.get(k)}


def price(values: Mapping[str, str], key: str) -> float | None:
    """A price, null if blank; anything else that is no number is an error."""
    raw = (values.get(key) or "").strip()
    if not raw:
        return None
    try:
        return float(raw)
    except ValueError:
        raise ValueError(f"{key} is not a number: {raw!r}") from None


def pricing(values: Mapping[str, str]) -> dict:
    return {
        "currency": (values.get("AI_COST_CURRENCY") or "USD").strip().upper() or "USD",
        "input_cost_per_1m_tokens": price(values, "AI_INPUT_COST_PER_1M_USD"), "output_cost_per_1m_tokens": price(values, "AI_OUTPUT_COST_PER_1M_USD"),
    }


@dataclass
class Settings:
    """Options of a run; ``strict`` repairs known quirks of the compatible rules."""

    extract: str = "render"  # images, render or both
    dpi: int = 200
    range_pages: int = 64  # pages that one task renders
    write_text: bool = False
    limit: int | None = None
    limit_pages: int = 0
    only_folder: str | None = None
    only_page: str | None = None
    diagram_filter: str = "auto"
    languages: str = "eng+tam"
    allow_next_line: bool = True
    force: bool = False
    dry_run: bool = False
    strict: bool = False
    extra: dict = field(default_factory=dict)
