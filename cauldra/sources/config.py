"""Sources to ingest, from a YAML or JSON file: shops with a paged catalogue, and a site of reviews."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from pathlib import Path

#: Environment variable that overrides the rate of the review site.
RATE_VARIABLE = "CAULDRA_REVIEWS_RATE"


@dataclass(frozen=True)
class Shop:
    base_url: str
    rate: float = 2.0
    display_name: str | None = None


@dataclass(frozen=True)
class Reviews:
    base_url: str
    rate: float = 0.1
    timeout: float = 60.0
    slugs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Config:
    shops: dict[str, Shop] = field(default_factory=dict)
    reviews: Reviews | None = None


def _made(kind: type, where: str, given) -> object:
    """``kind`` from a mapping; unknown, missing or misshapen entries raise ``ValueError``."""
    if not isinstance(given, dict):
        raise ValueError(f"{where}: a mapping is wanted, not {type(given).__name__}")
    known = {f.name for f in fields(kind)}
    if odd := set(given) - known:
        raise ValueError(f"{where}: unknown {sorted(odd)}")
    if not isinstance(given.get("base_url"), str) or not given["base_url"].strip():
        raise ValueError(f"{where}: base_url is missing")
    for name in ("rate", "timeout"):
        v = given.get(name, 1.0)
        if isinstance(v, bool) or not isinstance(v, (int, float)) or v <= 0:
            raise ValueError(f"{where}: {name} must be a number over 0")
    slugs = given.get("slugs", [])
    if not isinstance(slugs, list) or not all(isinstance(s, str) for s in slugs):
        raise ValueError(f"{where}: slugs must be a list of texts")
    return kind(**{**given, **({"slugs": tuple(slugs)} if "slugs" in known else {})})


def parse_config(text: str, where: str = "config") -> Config:
    """``shops``: key -> (base_url, rate, display_name); ``reviews``: (base_url, rate, timeout, slugs)."""
    try:
        import yaml

        given = yaml.safe_load(text)
    except ImportError:
        given = json.loads(text)
    if not isinstance(given, dict) or set(given) - {"shops", "reviews"}:
        raise ValueError(f"{where}: a mapping with shops and reviews is wanted")
    shops = given.get("shops") or {}
    if not isinstance(shops, dict):
        raise ValueError(f"{where}: shops must be a mapping")
    reviews = given.get("reviews")
    if reviews is not None and RATE_VARIABLE in os.environ:
        try:
            reviews = {**reviews, "rate": float(os.environ[RATE_VARIABLE])}
        except ValueError as e:
            raise ValueError(f"{RATE_VARIABLE} is no number") from e
    return Config({str(k): _made(Shop, f"{where}: shop {k}", v) for k, v in shops.items()}, None if reviews is None else _made(Reviews, f"{where}: reviews", reviews))


def read_config(path: str) -> Config:
    if not Path(path).is_file():
        raise ValueError(f"no config at {path}")
    return parse_config(Path(path).read_text(encoding="utf-8"), path)
