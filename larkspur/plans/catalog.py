"""Imports every query module, which registers its queries."""

from importlib import import_module

MODULES = ["profiling", "tables", "text", "evaluation", "models_bayes", "sources", "models"]


def register() -> None:
    for m in MODULES:
        import_module(f"larkspur.plans.{m}")
