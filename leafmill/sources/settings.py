"""Settings: a variable, its alternative, then a default. Text is stripped, passwords aren't; addresses lose trailing slashes."""

from __future__ import annotations

import os
from collections.abc import Mapping


def setting(names: list[str], default: str = "", env: Mapping[str, str] | None = None, strip: bool = True) -> str:
    values = os.environ if env is None else env
    for n in names:
        v = values.get(n, "")
        v = v.strip() if strip else v
        if v:
            return v
    return default


def base_url(names: list[str], default: str = "", env: Mapping[str, str] | None = None) -> str:
    return setting(names, default, env).rstrip("/")
