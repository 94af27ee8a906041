"""Training-data operators; nothing else in the library imports this subpackage."""

from __future__ import annotations

from importlib import import_module

from tessera.llm.textkit import tuned

#: One module per operator, in the order of their numbers.
MODULES = ("language_id", "chat_tools", "decontaminate", "minmax_dedup", "span_dedup", "mjpeg", "licenses", "warc", "toxicity", "mixture")


def queries() -> dict:
    return {name: tuned(f) for m in MODULES for name, f in import_module(f"tessera.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(import_module(f"tessera.llm.{m}"), "ORACLE", {}).items()}
