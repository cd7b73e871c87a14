"""The control of a run: settings, sources with limits and minimums, progress that a later run resumes, one run at a time.

Nothing here touches the network by itself: whoever fetches passes a function, so tests and air-gapped runs pass their own.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import shutil
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from entityspark.sources.readers import run_result
from entityspark.sources.sinks import atomic_json

OK, FAILED, BUSY = 0, 1, 75
TRUE = {"1", "true", "yes", "on"}


def dotenv(text: str) -> dict[str, str]:
    """NAME=value lines; comments, blank lines, ``export`` and quotes are passed over."""
    found = {}
    for line in text.splitlines():
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            value = m[2]
            quoted = re.match(r"""(["'])(.*?)\1""", value)
            found[m[1]] = quoted[2] if quoted else re.split(r"\s+#", value)[0]
    return found


def layered(*layers: Mapping[str, str] | str) -> dict[str, str]:
    """Settings from several places, the first that has a name wins. A text is the path of a file that may be missing."""
    found: dict[str, str] = {}
    for layer in layers:
        values = dotenv(Path(layer).read_text(encoding="utf-8-sig")) if isinstance(layer, str) and os.path.exists(layer) else {} if isinstance(layer, str) else layer
        found = dict(values) | found
    return found


@dataclass
class Settings:
    values: Mapping[str, str] = field(default_factory=dict)

    def flag(self, name: str, default: bool = False) -> bool:
        raw = self.values.get(name, "").strip().lower()
        return raw in TRUE if raw else default

    def number(self, name: str, default: int, least: int = 0) -> int:
        try:
            return max(least, int(self.values.get(name, "").strip() or default))
        except ValueError:
            return default

    def ratio(self, name: str, default: float) -> float:
        try:
            return min(1.0, max(0.0, float(self.values.get(name, "").strip() or default)))
        except ValueError:
            return default

    def minimums(self, name: str = "MIN_RECORDS") -> dict[str, int]:
        """``osm=100,vk=5``."""
        parts = (p.split("=") for p in re.split(r"[,;\s]+", self.values.get(name, "")) if p.count("=") == 1)
        return {k: int(v) for k, v in parts if v.isdigit()}


def redacted(text: str, settings: Settings, names: tuple[str, ...] = ("VK_TOKEN", "TG_BOT_TOKEN", "TG_CHAT_ID")) -> str:
    """A message without the secrets of the settings."""
    for name in names:
        secret = settings.values.get(name, "").strip()
        if len(secret) >= 6:
            text = text.replace(secret, "<redacted>")
    return text


class Refused(Exception):
    """An answer with a status that another try doesn't change."""


def retried(fetch: Callable[[], bytes], tries: int = 4, pauses: tuple[float, ...] = (1, 3, 8), sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The answer of the first try that gives one; OSError (time-outs, refused connections, overload) is tried again."""
    for k in range(tries):
        try:
            return fetch()
        except OSError:
            if k == tries - 1:
                raise
            sleep(pauses[min(k, len(pauses) - 1)])
    raise ValueError("at least one try is needed")


def first_mirror(mirrors: list[str], fetch: Callable[[str, float], bytes], each: float = 240, in_all: float = 900, clock: Callable[[], float] = time.monotonic) -> bytes:
    """The answer of the first mirror that gives one, each within its own time and all within theirs."""
    began, last = clock(), None
    for k, mirror in enumerate(mirrors):
        left = in_all - (clock() - began)
        if k and left <= 0:
            break
        try:
            return fetch(mirror, min(each, max(1.0, left)))
        except (OSError, ValueError) as e:
            last = e
    raise RuntimeError(f"no mirror answered: {last}")


@contextlib.contextmanager
def one_run(path: str) -> Iterator[None]:
    """Holds the lock of a folder; BlockingIOError where another run has it."""
    import fcntl

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a+") as f:
        fcntl.flock(f.fileno(), fcntl.LOCK_EX | fcntl.LOCK_NB)
        f.truncate(0)
        f.write(json.dumps({"pid": os.getpid()}))
        f.flush()
        yield


class Progress:
    """What a run has done, in one file that is replaced whole; a resumed run goes on from it."""

    def __init__(self, path: str):
        self.path = path

    def read(self) -> dict:
        try:
            with open(self.path, encoding="utf-8") as f:
                found = json.load(f)
                return found if isinstance(found, dict) else {}
        except (OSError, ValueError):
            return {}

    def update(self, **fields: object) -> dict:
        state = self.read() | fields
        atomic_json(state, self.path)
        return state

    def start(self, **fields: object) -> dict:
        atomic_json({"status": "running", "stage": "init", "completed_sources": [], "source_results": []} | fields, self.path)
        return self.read()

    def completed(self, source: str, result: dict) -> dict:
        state = self.read()
        done = state.get("completed_sources", [])
        ok = [source] if result.get("status") == "ok" and source not in done else []
        return self.update(completed_sources=[*done, *ok], source_results=[*state.get("source_results", []), result])

    def open_sources(self, sources: list[str], resume: bool) -> list[str]:
        done = set(self.read().get("completed_sources", [])) if resume else set()
        return [s for s in sources if s not in done]

    def reset(self, *more: str) -> None:
        """Forget this run and further state, files or folders."""
        for path in (self.path, *more):
            if os.path.isdir(path):
                shutil.rmtree(path)
            elif os.path.exists(path):
                os.remove(path)


#: A source: what it is called, and what runs it with the limits (cities, queries, items) and gives a count or a report.
Source = tuple[str, Callable[[dict[str, int]], object]]


def limits(settings: Settings) -> dict[str, int]:
    return {k: settings.number(f"MAX_{k.upper()}", 0) for k in ("cities", "queries_per_source", "items_per_source")}


def run_sources(sources: list[Source], settings: Settings, progress: Progress, observed: Callable[[], int], resume: bool = False) -> list[str]:
    """Run what isn't completed; the failures, among them sources with fewer records than their minimum. One source's error
    leaves the others."""
    failures = []
    for name in progress.open_sources([s for s, _ in sources], resume):
        before, status, error, count = observed(), "ok", "", 0
        try:
            value = dict(sources)[name](limits(settings))
            count, _ = run_result(value, max(0, observed() - before))
            least = settings.minimums().get(name, 0)
            if count < least:
                status, error = "failed", f"observed {count} records; minimum for {name} is {least}"
        except Exception as e:  # a source may fail in any way
            status, error = "failed", redacted(f"{type(e).__name__}: {e}", settings)[:500]
        progress.completed(name, {"key": name, "status": status, "records": count, "error": error})
        if error:
            failures.append(f"{name}: {error}")
    return failures


def preflight(settings: Settings, folder: str, sources: list[str], known: list[str], least_bytes: int = 1 << 30) -> tuple[list[str], list[str]]:
    """(errors, warnings) before anything is fetched."""
    errors = [f"unknown source: {s}" for s in sources if s not in known]
    warnings = []
    if not sources:
        errors.append("no source is chosen")
    if "vk" in sources and not settings.values.get("VK_TOKEN", "").strip():
        (warnings if len(sources) > 1 else errors).append("VK_TOKEN is not set: the source is passed over")
    if bool(settings.values.get("TG_BOT_TOKEN", "").strip()) != bool(settings.values.get("TG_CHAT_ID", "").strip()):
        warnings.append("TG_BOT_TOKEN and TG_CHAT_ID belong together")
    for path in filter(None, settings.values.get("EXCLUDE_MASTERS", "").split(";")):
        if not os.path.exists(path.strip()):
            warnings.append(f"EXCLUDE_MASTERS: no such file: {path.strip()}")
    at = Path(folder)
    while not at.exists():
        at = at.parent
    if not os.access(at, os.W_OK):
        errors.append(f"{folder} can't be written")
    elif shutil.disk_usage(at).free < least_bytes:
        errors.append(f"{folder} has less than {least_bytes} bytes left")
    return errors, warnings


def summary_text(total: int, filled: Mapping[str, int], by_source: Mapping[str, int], by_city: Mapping[str, int], top: int = 10) -> str:
    """A run in a few lines: contacts in whole per cent, rows by source, the largest cities."""
    percent = lambda n: n * 100 // total if total else 0
    largest = sorted(by_city.items(), key=lambda x: (-x[1], x[0]))[:top]
    lines = [f"{total} rows", *(f"{k}: {n} ({percent(n)} %)" for k, n in filled.items()), "by source: " + ", ".join(f"{k} {n}" for k, n in sorted(by_source.items(), key=lambda x: (-x[1], x[0])))]
    return "\n".join([*lines, "cities: " + ", ".join(f"{k} {n}" for k, n in largest)])


def exit_code(failures: list[str], busy: bool = False) -> int:
    return BUSY if busy else FAILED if failures else OK
