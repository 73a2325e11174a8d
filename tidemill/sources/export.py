"""Exporting a signal: splicing it into a source template, dated and latest files, copies to an archive, retries."""

from __future__ import annotations

import ast
import shutil
import time
from collections.abc import Callable
from pathlib import Path
from pprint import pformat

from .sinks import write_json, write_text


def splice_assignment(source: str, name: str, value: object) -> str:
    """source with the module-level assignment to name replaced by the value's literal."""
    for node in ast.parse(source).body:
        targets = node.targets if isinstance(node, ast.Assign) else [node.target] if isinstance(node, ast.AnnAssign) else []
        if any(isinstance(t, ast.Name) and t.id == name for t in targets):
            lines = source.splitlines(keepends=True)
            new = f"{name} = {pformat(value, sort_dicts=False)}\n"
            return "".join([*lines[: node.lineno - 1], new, *lines[node.end_lineno :]])
    raise ValueError(f"the template does not assign {name}")


def export_signal(payload: dict, folder: str, date: str, template: str | None = None, name: str = "SIGNAL") -> list[Path]:
    """signal_<date> and signal_latest as JSON, and with a template as Python."""
    out = []
    for stem in (f"signal_{date}", "signal_latest"):
        out.append(Path(folder) / f"{stem}.json")
        write_json(out[-1], payload)
        if template is not None:
            out.append(Path(folder) / f"{stem}.py")
            write_text(out[-1], splice_assignment(template, name, payload))
    return out


def mirror(source: str, target: str) -> int:
    """Files under source that target lacks or has in another size or age; how many were copied."""
    n = 0
    for p in Path(source).rglob("*"):
        if p.is_file():
            q = Path(target) / p.relative_to(source)
            if not q.exists() or q.stat().st_size != p.stat().st_size or q.stat().st_mtime < p.stat().st_mtime:
                q.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy2(p, q)
                n += 1
    return n


def with_retries(call: Callable, attempts: int = 3, wait: float = 1.0):
    """call()'s result; the last error after so many attempts."""
    for k in range(attempts):
        try:
            return call()
        except Exception:
            if k == attempts - 1:
                raise
            time.sleep(wait)
