"""Configuration on the driver: profiles, overlays, checks of settings, named flows, and validation around functions of DataFrames."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.constants import PROFILES, Profile
from folio.operators import contracts


def profile(name: str | None = None, variable: str = "READERS_PROFILE") -> Profile:
    """The thresholds of the named deployment, else of the one in the environment, else of production."""
    chosen = name or os.environ.get(variable) or "prod"
    if chosen not in PROFILES:
        raise ValueError(f"unknown profile: {chosen}")
    return PROFILES[chosen]


def overlaid(base: dict, over: dict | None) -> dict:
    """base with the members of over; dictionaries merge, everything else is replaced."""
    out = dict(base)
    for k, v in (over or {}).items():
        out[k] = overlaid(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def faults(settings: dict, required: tuple[str, ...] = (), ranges: dict[str, tuple[float, float]] | None = None, types: dict[str, type] | None = None) -> list[str]:
    """What is wrong with settings; names may be dotted paths. Bounds belong to their range."""
    found = []

    def at(path: str):
        node = settings
        for part in path.split("."):
            if not isinstance(node, dict) or part not in node:
                return None
            node = node[part]
        return node

    found += [f"{p} is missing" for p in required if at(p) is None]
    for p, (low, high) in (ranges or {}).items():
        v = at(p)
        if v is not None and not (isinstance(v, (int, float)) and low <= v <= high):
            found.append(f"{p} is not within {low} and {high}")
    for p, kind in (types or {}).items():
        v = at(p)
        if v is not None and not isinstance(v, kind):
            found.append(f"{p} is not {kind.__name__}")
    return found


class Flows:
    """Named functions of (spark, path) that give a DataFrame."""

    def __init__(self):
        self._known: dict[str, Callable[..., DataFrame]] = {}

    def register(self, name: str, flow: Callable[..., DataFrame]) -> None:
        self._known[name] = flow

    def has(self, name: str) -> bool:
        return name in self._known

    def run(self, name: str, *args, **kwargs) -> DataFrame:
        if name not in self._known:
            raise KeyError(f"unknown flow: {name}")
        return self._known[name](*args, **kwargs)


class ContractError(ValueError):
    """VL-E001 for what goes into a function, VL-E002 for what comes out."""


def checked(before: dict | None = None, after: dict | None = None, soft: bool = False, demoted: tuple[str, ...] = ()) -> Callable:
    """Validates the first argument and the result of a function of DataFrames. Soft validation only adds the column `violations`;
    otherwise a row that breaks the contract raises, with the first five violations."""

    def check(df: DataFrame, schema: dict | None, code: str) -> DataFrame:
        if schema is None:
            return df
        marked = contracts.validate(df, schema)
        if soft:
            return marked
        errors, _ = contracts.demote(F.col("violations"), demoted)
        bad = marked.select(F.explode(errors).alias("v")).select("v.*").limit(5).collect()
        if bad:
            raise ContractError(f"{code}: " + "; ".join(f"{b.path} {b.validator} {b.message}" for b in bad))
        return df

    def around(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(f)
        def call(df: DataFrame, *args, **kwargs) -> DataFrame:
            return check(f(check(df, before, "VL-E001"), *args, **kwargs), after, "VL-E002")

        return call

    return around
