"""Settings of an update from environment variables."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass

from folioforge.operators.gate import MIN_RATIO
from folioforge.plans.update import Webhook, parse_languages
from folioforge.sources.fetch import ATTEMPTS, IDLE_SECONDS


@dataclass(frozen=True)
class Settings:
    api_key: str
    base_url: str
    webhooks: tuple[Webhook, ...]
    data_dir: str = "data"
    idle_seconds: float = IDLE_SECONDS
    attempts: int = ATTEMPTS
    languages: tuple[str, ...] = parse_languages(None)
    min_ratio: float = MIN_RATIO

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> Settings:
        """API_KEY, BASE_URL and WEBHOOKS must be there; DATA_DIR, DOWNLOAD_IDLE_TIMEOUT_SECS, DOWNLOAD_MAX_ATTEMPTS, ALLOWED_LANGS and MIN_STAGING_RATIO may be.

        A value that can't be read is an error, an optional one too.
        """
        env = os.environ if env is None else env
        missing = [n for n in ("API_KEY", "BASE_URL", "WEBHOOKS") if n not in env]
        if missing:
            raise KeyError(f"not set: {', '.join(missing)}")
        hooks = tuple(Webhook(h["url"], h.get("method", "POST").upper(), h.get("headers", {})) for h in json.loads(env["WEBHOOKS"]))
        if wrong := [h.method for h in hooks if h.method not in ("GET", "POST")]:
            raise ValueError(f"webhook methods are GET and POST, not {', '.join(wrong)}")
        return cls(
            env["API_KEY"],
            env["BASE_URL"],
            hooks,
            env.get("DATA_DIR", "data"),
            float(env.get("DOWNLOAD_IDLE_TIMEOUT_SECS", IDLE_SECONDS)),
            int(env.get("DOWNLOAD_MAX_ATTEMPTS", ATTEMPTS)),
            parse_languages(env.get("ALLOWED_LANGS")),
            float(env.get("MIN_STAGING_RATIO", MIN_RATIO)),
        )
