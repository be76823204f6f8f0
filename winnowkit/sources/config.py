"""Configuration from TOML, checked when it is read.

Tables: search (searchstate_path, or searchstate_paths), scrape (delay_seconds, max_pages,
compress), home (latitude, longitude), location (radius_miles, excluded_states), filters
(excluded_sources, excluded_website_tlds), screen (comp_floor, comp_min_floor,
wide_geography_cities, company_blocklist), capture (dir), visit_logger (export_path). [search] is
required, and [home] where companies are rolled up. A table or setting of another name is an
error: it would be ignored without a word. Relative paths start at the file's folder.
"""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from .. import fixed

SETTINGS = {
    "search": ("searchstate_path", "searchstate_paths"),
    "scrape": ("delay_seconds", "max_pages", "compress"),
    "home": ("latitude", "longitude"),
    "location": ("radius_miles", "excluded_states"),
    "filters": ("excluded_sources", "excluded_website_tlds"),
    "screen": ("comp_floor", "comp_min_floor", "wide_geography_cities", "company_blocklist"),
    "capture": ("dir",),
    "visit_logger": ("export_path",),
}


class ConfigError(ValueError):
    """The configuration can't be used; the message names the setting."""


@dataclass(frozen=True)
class Search:
    name: str
    state: dict = field(hash=False)

    @property
    def window(self) -> int | None:
        days = self.state.get(fixed.WINDOW_FIELD)
        return days if isinstance(days, int) and not isinstance(days, bool) else None


@dataclass(frozen=True)
class Config:
    search_files: tuple[Path, ...] = ()
    max_pages: int = 500
    delay_seconds: float = 1.0
    compress: bool = True
    home_lat: float = 0.0
    home_lon: float = 0.0
    radius_miles: float = 30.0
    excluded_states: tuple[str, ...] = ()
    excluded_sources: tuple[str, ...] = ()
    excluded_domains: tuple[str, ...] = ()
    visit_log: Path | None = None
    capture_dir: Path | None = None
    comp_floor: int = fixed.COMP_FLOOR
    comp_min_floor: int = fixed.COMP_MIN_FLOOR
    wide_geography_cities: int = fixed.WIDE_GEOGRAPHY_CITIES
    blocked_companies: tuple[str, ...] = ()

    def searches(self) -> list[Search]:
        """The configured searches with their states, in order."""
        return [Search(p.stem, load_state(p)) for p in self.search_files]


class _Table:
    """One table of a file, with the checks that its settings share."""

    def __init__(self, raw: dict, name: str, path: Path):
        found = raw.get(name, {})
        if not isinstance(found, dict):
            raise ConfigError(f"{path}: [{name}] must be a table")
        self.raw, self.where = found, f"{path}: [{name}]"
        if unknown := sorted(set(found) - set(SETTINGS[name])):
            raise ConfigError(f"{self.where} has no setting {', '.join(unknown)}")

    def fail(self, key: str, what: str) -> ConfigError:
        return ConfigError(f"{self.where}.{key} {what}")

    def number(self, key: str, default: float, low: float | None = None, high: float | None = None, whole: bool = False) -> Any:
        value = self.raw.get(key, default)
        if isinstance(value, bool) or not isinstance(value, int if whole else (int, float)):
            raise self.fail(key, "must be a whole number" if whole else "must be a number")
        if low is not None and value < low or high is not None and value > high:
            raise self.fail(key, f"must lie between {'-' if low is None else f'{low:g}'} and {'-' if high is None else f'{high:g}'}")
        return value if whole else float(value)

    def strings(self, key: str) -> tuple[str, ...]:
        value = self.raw.get(key, [])
        if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
            raise self.fail(key, "must be a list of strings")
        return tuple(v for v in value if v.strip())

    def flag(self, key: str, default: bool) -> bool:
        value = self.raw.get(key, default)
        if not isinstance(value, bool):
            raise self.fail(key, "must be true or false")
        return value

    def text(self, key: str, empty: bool = False) -> str | None:
        value = self.raw.get(key)
        if value is not None and (not isinstance(value, str) or not empty and not value.strip()):
            raise self.fail(key, "must be a string" if empty else "must be a string that isn't empty")
        return value or None


def load_state(path: Path) -> dict:
    """A search's opaque state; an empty one would ask for everything and is refused."""
    try:
        state = json.loads(path.read_text(encoding="utf-8"))
    except OSError as e:
        raise ConfigError(f"{path}: {e.strerror}") from e
    except ValueError as e:
        raise ConfigError(f"{path} is not JSON") from e
    if not isinstance(state, dict) or not state:
        raise ConfigError(f"{path} must hold a search state that isn't empty")
    return state


def _search_files(t: _Table) -> list[str]:
    listed = t.raw.get("searchstate_paths")
    if listed is None:
        one = t.text("searchstate_path")
        if one is None:
            raise t.fail("searchstate_path", "must be a string that isn't empty")
        return [one]
    if "searchstate_path" in t.raw:
        raise t.fail("searchstate_path", "and searchstate_paths can't be given together")
    if not isinstance(listed, list) or not listed or not all(isinstance(x, str) and x.strip() for x in listed):
        raise t.fail("searchstate_paths", "must be a list of strings that aren't empty")
    return listed


def load(path: str | Path, need: tuple[str, ...] = ("search",)) -> Config:
    """Read a configuration; ``need`` names the tables it must have."""
    path = Path(path)
    try:
        raw = tomllib.loads(path.read_text(encoding="utf-8"))
    except OSError as e:
        raise ConfigError(f"{path}: {e.strerror}") from e
    except tomllib.TOMLDecodeError as e:
        raise ConfigError(f"{path}: {e}") from e
    if unknown := sorted(set(raw) - set(SETTINGS)):
        raise ConfigError(f"{path} has no table [{'], ['.join(unknown)}]")
    if missing := [n for n in need if n not in raw]:
        raise ConfigError(f"{path} lacks [{'], ['.join(missing)}]")
    search, scrape, home, location, filters, screen, capture, visits = (_Table(raw, n, path) for n in SETTINGS)
    at = lambda p: (path.parent / Path(p).expanduser()).resolve()
    files = [at(f) for f in _search_files(search)] if "search" in raw else []
    if len(set(files)) != len(files):
        raise search.fail("searchstate_paths", "names a file twice")
    floor = screen.number("comp_floor", fixed.COMP_FLOOR, 0, whole=True)
    low = screen.number("comp_min_floor", fixed.COMP_MIN_FLOOR, 0, whole=True)
    if low > floor:
        raise screen.fail("comp_min_floor", f"must not be above comp_floor, {floor}")
    log, captures = visits.text("export_path", empty=True), capture.text("dir")
    return Config(
        search_files=tuple(files), max_pages=scrape.number("max_pages", 500, 1, whole=True), delay_seconds=scrape.number("delay_seconds", 1.0, 0),
        compress=scrape.flag("compress", True), home_lat=home.number("latitude", 0.0, -90, 90), home_lon=home.number("longitude", 0.0, -180, 180),
        radius_miles=location.number("radius_miles", 30.0, 0), excluded_states=location.strings("excluded_states"),
        excluded_sources=filters.strings("excluded_sources"), excluded_domains=filters.strings("excluded_website_tlds"),
        visit_log=at(log) if log else None, capture_dir=at(captures) if captures else None, comp_floor=floor, comp_min_floor=low,
        wide_geography_cities=screen.number("wide_geography_cities", fixed.WIDE_GEOGRAPHY_CITIES, 0, whole=True),
        blocked_companies=tuple(x.strip().lower() for x in screen.strings("company_blocklist")),
    )
