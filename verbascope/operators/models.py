"""Loading of caller-supplied models in Python workers."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping

# Picklable; needs no argument, or one, the settings of the job, and returns the model.
ModelFactory = Callable[..., Callable]

_LOADED: dict[str, Callable] = {}


def load(factory: ModelFactory, settings: Mapping[str, object]) -> Callable:
    """Call a factory, with the settings of the job if it cannot be called without an argument."""
    asks = any(p.default is p.empty and p.kind is not p.VAR_KEYWORD and p.kind is not p.VAR_POSITIONAL for p in inspect.signature(factory).parameters.values())
    return factory(dict(settings)) if asks else factory()


def loaded(job: str, factory: ModelFactory, settings: Mapping[str, object]) -> Callable:
    """The worker's one instance of a job's model; later tasks on the worker find it loaded."""
    if job not in _LOADED:
        _LOADED[job] = load(factory, settings)
    return _LOADED[job]
