"""Runnable queries over the benchmark tables, each with its SQL counterpart."""

from rosterforge.catalog.base import REGISTRY
from rosterforge.catalog import enrich, publish, refine, register, run, sites, synth  # noqa: F401

__all__ = ["REGISTRY"]
