"""The registry of all queries."""

from __future__ import annotations

from importlib import import_module

from millrace.plans.registry import Registry

MODULES = "quality profile reports features tables ingest reviews evaluation models jobs".split()

REGISTRY = Registry()
for _name in MODULES:
    import_module(f"millrace.plans.queries_{_name}").register(REGISTRY)
