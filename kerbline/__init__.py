"""kerbline: trip analytics as Spark jobs.

Monthly trip files and a zone lookup become bronze, silver and gold tables, a
quality gate and a set of reports. Functions take and return DataFrames;
nothing here opens a session or reads the clock for an identifier.
"""

from kerbline.operators.quality import TripLimits
from kerbline.plans.incremental import Lake, RunReport, run_months

__all__ = ["Lake", "RunReport", "TripLimits", "run_months"]
