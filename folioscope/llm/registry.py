"""The query modules of this subpackage."""

from __future__ import annotations

import importlib
from types import ModuleType

NAMES = ("layout_duplicates", "look_alikes", "splitting", "canonical_values", "similar_vectors", "encoding", "leakage", "spam_pages")


def modules() -> list[ModuleType]:
    return [importlib.import_module(f"folioscope.llm.queries.{name}") for name in NAMES]
