"""Settings, from the environment or given."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


def _list(value: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in value.split(",") if x.strip())


@dataclass(frozen=True)
class Config:
    """``window_minutes`` must be a number: anything else is refused (a deliberate difference: it would silently give no posts)."""

    # Defaults of instances, tags and query.
    instances: tuple[str, ...] = ("pawoo.net", "mstdn.jp", "fedibird.com", "mastodon.social")
    tags: tuple[str, ...] = ("ramen", "ラーメン", "らーめん", "つけ麺", "家系")
    x_query: str = "(ラーメン OR ramen OR つけ麺) has:images -is:retweet"
    x_token: str | None = None
    window_minutes: float = 60.0
    future_seconds: int = 60
    use_fallback: bool = True
    timeout_seconds: float = 8.0
    refresh_seconds: int = 30
    fresh_minutes: int = 10
    port: int = 3000

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        env = os.environ if env is None else env
        return cls(
            instances=_list(env.get("MASTODON_INSTANCES") or ",".join(cls.instances)),
            tags=_list(env.get("RAMEN_TAGS") or ",".join(cls.tags)),
            x_query=env.get("X_QUERY") or cls.x_query,
            x_token=env.get("X_BEARER_TOKEN") or None,
            window_minutes=float(env.get("WINDOW_MINUTES") or 60),
            use_fallback=env.get("USE_SAMPLE_FALLBACK") != "false",
            port=int(env.get("PORT") or cls.port),
        )
