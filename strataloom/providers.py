"""Model providers: callables outside of plans. A breaker around one keeps a dead gateway from being asked again and again."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from typing import Protocol

from strataloom.functions.links import LOCAL_PROVIDER
from strataloom.operators.breaker import LIMIT, Breaker

# Settings from the environment.
COOLDOWN, BASE_URL = "AI_BREAKER_COOLDOWN", "AI_BASE_URL"


class Provider(Protocol):
    def call_api(self, prompt: str) -> str: ...


class Unavailable(RuntimeError):
    """The breaker is open: the call wasn't sent."""


_FACTORIES: dict[str, Callable[..., Provider]] = {}
_STATE = Breaker(limit=LIMIT)


def register(name: str, factory: Callable[..., Provider]) -> None:
    _FACTORIES[name.strip().lower()] = factory


def build(name: str | None, **options) -> Provider:
    """A provider by name; the local one has several names. An unknown name falls to the factory `default`, if there is one."""
    key = (name or "").strip().lower()
    key = "local" if key in LOCAL_PROVIDER else key
    factory = _FACTORIES.get(key) or _FACTORIES.get("default")
    if factory is None:
        raise KeyError(f"no provider {name!r}")
    return factory(**options)


class Compatible:
    """An endpoint of the common chat protocol. `send(url, headers, body)` does the network's part and returns the answer's text."""

    def __init__(self, api_key: str = "", model: str | None = None, base_url: str | None = None, send: Callable[[str, dict, dict], str] | None = None):
        base = (base_url if base_url is not None else os.environ.get(BASE_URL, "")).rstrip("/")
        self.base_url = base if base.endswith("/chat/completions") else f"{base}/chat/completions"
        self.api_key, self.model, self._send = api_key, model, send

    def call_api(self, prompt: str) -> str:
        if self._send is None:
            raise Unavailable("no transport")
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}]}
        return self._send(self.base_url, {"Authorization": f"Bearer {self.api_key}"}, body)


register("aigw", Compatible)


def reset() -> None:
    """Closes the process's breaker."""
    _STATE.streak, _STATE.opened = 0, None


def available() -> bool:
    return _STATE.opened is None


class Guarded:
    """Sends calls through the process's breaker; everything else is the inner provider's."""

    def __init__(self, inner: Provider, clock: Callable[[], float] = time.monotonic):
        self.inner, self._clock = inner, clock

    def __getattr__(self, name: str):
        return getattr(self.inner, name)

    def call_api(self, prompt: str) -> str:
        now, cooldown = self._clock(), float(os.environ.get(COOLDOWN, "300"))
        if _STATE.opened is not None and now - _STATE.opened < cooldown:
            raise Unavailable("too many failures in a row")
        _STATE.cooldown = 0.0  # whether this call may be sent is decided above
        try:
            answer = self.inner.call_api(prompt)
        except Exception:
            _STATE.call(now, True)
            raise
        _STATE.call(now, False)
        return answer


def guarded(provider: Provider | None) -> Provider | None:
    """The provider behind the breaker; one that is already, and None, stay as they are."""
    return provider if provider is None or isinstance(provider, Guarded) else Guarded(provider)


def ask(provider: Provider | None, prompt: str, text: str | None) -> str:
    """The trimmed answer; empty without a provider or a text to ask about, and on any error."""
    if provider is None or not text:
        return ""
    try:
        return (provider.call_api(prompt) or "").strip()
    except Exception:  # noqa: BLE001  an enrichment never stops a run
        return ""
