"""Settings: a local mapping before the environment before defaults."""

from __future__ import annotations

from collections.abc import Mapping, MutableMapping


def merged(local: Mapping[str, object], environ: Mapping[str, str], defaults: Mapping[str, object]) -> dict[str, object]:
    """Each default's name with its local value, else the environment's, else the default. Empty strings count as unset."""
    unset = (None, "")
    return {k: next((v for v in (local.get(k), environ.get(k)) if v not in unset), d) for k, d in defaults.items()}


def exported(local: Mapping[str, object], environ: MutableMapping[str, str]) -> None:
    """Puts local scalars where the environment has no value; a <placeholder> is none."""
    for name, value in local.items():
        if isinstance(value, (str, int, float)) and not (isinstance(value, str) and value.startswith("<") and value.endswith(">")):
            environ.setdefault(name, str(value))
