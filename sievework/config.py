"""Settings of a run: a JSON file, then variables of the environment, each parsed as the field's own type; and groups of endpoints."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path
from typing import Any
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

API_VERSION = "2024-06-01"


@dataclass
class Endpoint:
    name: str
    url: str
    provider: str = "openai_compatible"
    model: str = ""
    auth_type: str = "none"
    api_key: str = ""
    api_version: str = ""
    deployment: str = ""
    max_concurrent: int = 0
    weight: float = 1.0
    extra_headers: dict[str, str] = field(default_factory=dict)

    def prepared(self, payload: dict[str, Any], headers: Mapping[str, str] | None = None) -> tuple[str, dict[str, Any], dict[str, str]]:
        """URL, payload and headers of a request, by the provider's rules."""
        if not self.url:
            raise ValueError(f"endpoint {self.name!r} has no url")
        asks = self.auth_type.strip().lower()
        if asks == "api_key" and not self.api_key:
            raise ValueError(f"endpoint {self.name!r} asks for a key and has none")
        made = {**(headers or {}), **self.extra_headers}
        if self.provider == "azure_openai":
            if asks != "api_key":
                raise ValueError(f"endpoint {self.name!r}: only keys are supported")
            return self._deployed(), {k: v for k, v in payload.items() if k != "model"}, {**made, "api-key": self.api_key}
        if self.api_key:
            made.setdefault("Authorization", f"Bearer {self.api_key}")
        return self.url, {**({"model": self.model} if self.model else {}), **payload}, made

    def _deployed(self) -> str:
        url = self.url.rstrip("/")
        if not url.endswith("/chat/completions"):
            target = self.deployment or self.model
            if not target:
                raise ValueError(f"endpoint {self.name!r} needs a deployment or a model")
            url = f"{url}/openai/deployments/{target}/chat/completions"
        parts = urlsplit(url)
        query = {"api-version": self.api_version or API_VERSION, **dict(parse_qsl(parts.query, keep_blank_values=True))}
        return urlunsplit(parts._replace(query=urlencode(query)))


@dataclass
class Settings:
    task_name: str = "caption_to_vqa"
    task_config: dict[str, Any] = field(default_factory=dict)
    output: str = "outputs/results"
    errors: str = "outputs/errors"
    id_field: str = "id"
    resume: bool = True
    concurrency: int = 16
    tasks: int = 0
    retries: int = 3
    backoff: float = 1.0
    route_strategy: str = "stable_hash"
    route_failover: str = "rotate_on_retry"
    endpoint_file: str = ""
    endpoint_group: str = ""
    urls: list[str] = field(default_factory=list)
    endpoints: list[dict[str, Any]] = field(default_factory=list)
    flush_seconds: float = 30.0

    @classmethod
    def read(cls, path: str | None = None, environment: Mapping[str, str] | None = None, prefix: str = "SIEVEWORK_") -> Settings:
        raw = json.loads(Path(path).read_text(encoding="utf-8")) if path else {}
        if not isinstance(raw, dict):
            raise ValueError(f"{path} does not hold an object")
        known = {f.name for f in fields(cls)}
        if unknown := set(raw) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        held, given = asdict(cls(**raw)), os.environ if environment is None else environment
        for name, old in held.items():
            if (text := given.get(prefix + name.upper())) is not None:
                held[name] = parsed(text, old)
        return cls(**held)

    def resolved(self) -> list[Endpoint]:
        """Endpoints given here, else those of the group, else one for each url."""
        if self.endpoints:
            return [endpoint(x) for x in self.endpoints]
        if self.endpoint_file and self.endpoint_group and Path(self.endpoint_file).exists():
            return group(Path(self.endpoint_file).read_text(encoding="utf-8"), self.endpoint_group)
        if urls := [u.strip() for u in self.urls if u.strip()]:
            return [Endpoint(f"fallback-{i}", u) for i, u in enumerate(urls)]
        raise ValueError("no endpoints: give endpoints, a group in a file, or urls")


def parsed(text: str, old: Any) -> Any:
    """text as a value of the kind of `old`."""
    if isinstance(old, bool):
        return text.strip().lower() in ("1", "true", "yes", "on")
    if isinstance(old, (int, float)):
        return type(old)(text)
    if isinstance(old, list) and not text.strip().startswith("["):
        return [x.strip() for x in text.split(",") if x.strip()]
    if isinstance(old, (dict, list)):
        value = json.loads(text)
        if not isinstance(value, type(old)):
            raise ValueError(f"not a {type(old).__name__}: {text}")
        return value
    return text


def endpoint(raw: Mapping[str, Any]) -> Endpoint:
    known = {f.name for f in fields(Endpoint)}
    found = Endpoint(**{"name": "", "url": "", **{k: v for k, v in raw.items() if k in known and v is not None}})
    if raw.get("api_key_env") and not found.api_key:
        found.api_key = os.environ.get(raw["api_key_env"], "")
    return found


def group(text: str, name: str) -> list[Endpoint]:
    """The endpoints of a group in a JSON document {"groups": {name: [...] or {"endpoints": [...]}}}."""
    groups = json.loads(text).get("groups")
    if not isinstance(groups, dict):
        raise ValueError("the file has no groups of endpoints")
    if name not in groups:
        raise ValueError(f"no group {name!r}; there are {', '.join(sorted(groups))}")
    held = groups[name].get("endpoints", []) if isinstance(groups[name], dict) else groups[name]
    if not isinstance(held, list):
        raise ValueError(f"group {name!r} is no list")
    return [endpoint(x) for x in held if isinstance(x, dict)]
