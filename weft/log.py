"""Loggers of the engine: one handler on standard error, level from $WEFT_LOG (INFO if unset)."""

from __future__ import annotations

import logging
import os


def logger(name: str) -> logging.Logger:
    top = logging.getLogger("weft")
    if not top.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        top.addHandler(handler)
        top.setLevel(os.environ.get("WEFT_LOG", "INFO").upper())
        top.propagate = False
    return top.getChild(name)
