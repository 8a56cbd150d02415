"""Sources that can't be read here, and why."""

from __future__ import annotations

import importlib


class SourceUnavailable(RuntimeError):
    """The source needs a network or a library that is not there."""


def need(module: str):
    """A library that a source can't do without."""
    try:
        return importlib.import_module(module)
    except ImportError as why:
        raise SourceUnavailable(f"{module} is not installed") from why
