"""Whole runs: from staged dump files to the two tables."""

from palimpsest.plans.convert import convert
from palimpsest.plans.ingest import check_staged_files
from palimpsest.plans.run import Options, run

__all__ = ["Options", "check_staged_files", "convert", "run"]
