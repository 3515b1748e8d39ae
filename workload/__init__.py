"""Queries over the driver tables, each with the SQL it must agree with."""

from . import config_cases, export_cases, harmonise_cases, ingest_cases, stage_cases  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
