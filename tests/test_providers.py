"""Providers behind the breaker, settings, and the optional PDF reader."""

from __future__ import annotations

import pytest

from strataloom import config, providers
from strataloom.functions.pdf import read_pdf


class Gateway:
    """Fails for its first `down` calls."""

    model = "m"

    def __init__(self, down=0, says="ok"):
        self.down, self.says, self.calls = down, says, 0

    def call_api(self, prompt):
        self.calls += 1
        if self.calls > self.down:
            return self.says
        raise ConnectionError(prompt)


@pytest.fixture(autouse=True)
def closed():
    providers.reset()
    yield
    providers.reset()


def test_breaker_stops_calls():
    inner = Gateway(down=9)
    p = providers.guarded(inner)
    assert [providers.ask(p, "p", "t") for _ in range(20)] == [""] * 20 and inner.calls == 2
    with pytest.raises(providers.Unavailable):
        p.call_api("p")


def test_probe_closes_or_reopens(monkeypatch):
    monkeypatch.setenv(providers.COOLDOWN, "0")
    inner = Gateway(down=3, says="back")
    p = providers.guarded(inner)
    for _ in range(3):
        providers.ask(p, "p", "t")
    assert inner.calls == 3 and not providers.available()
    monkeypatch.setenv(providers.COOLDOWN, "3600")
    assert providers.ask(p, "p", "t") == "" and inner.calls == 3
    monkeypatch.setenv(providers.COOLDOWN, "0")
    assert providers.ask(p, "p", "t") == "back" and providers.available()


def test_wrapping():
    p = providers.guarded(Gateway())
    assert p.model == "m" and providers.guarded(p) is p and providers.guarded(None) is None
    assert providers.ask(None, "p", "t") == "" == providers.ask(p, "p", "")


def test_factory():
    providers.register("local", lambda **k: Gateway(says="l"))
    providers.register("default", lambda **k: Gateway(says="d"))
    assert [providers.build(n).call_api("") for n in (" LK ", "local-kimi", "other", None)] == ["l", "l", "d", "d"]


def test_settings():
    assert config.merged({"A": "l", "B": ""}, {"A": "e", "B": "e"}, {"A": 1, "B": 2, "C": 3}) == {"A": "l", "B": "e", "C": 3}
    env = {"X": "real"}
    config.exported({"X": "local", "Y": 5, "Z": "<your key>", "L": [1]}, env)
    assert env == {"X": "real", "Y": "5"}


def test_pdf_without_bytes():
    assert read_pdf(b"") == "" == read_pdf(None) == read_pdf(b"not a pdf")


def test_compatible_endpoint(monkeypatch):
    sent = []
    monkeypatch.setenv(providers.BASE_URL, "https://models.example.org/v2/")
    p = providers.build("AIGW", api_key="k", model="m1", send=lambda url, headers, body: sent.append((url, headers, body)) or "yes")
    assert isinstance(p, providers.Compatible) and p.base_url == "https://models.example.org/v2/chat/completions" and p.call_api("q") == "yes"
    assert sent[0][1]["Authorization"] == "Bearer k" and sent[0][2]["model"] == "m1" and sent[0][2]["messages"][0]["content"] == "q"
    with pytest.raises(providers.Unavailable):
        providers.Compatible(base_url="https://x/chat/completions").call_api("q")
