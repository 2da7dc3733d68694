"""arenaspark: two-sided contest, panel and profile analytics on Spark DataFrames.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
built-in Spark SQL expressions, joins, aggregates and windows, so that
Catalyst plans it and the same code runs on any cluster size.
"""

from arenaspark.specs import ContestSpec, PanelSpec, ProfileSpec

__all__ = ["ContestSpec", "PanelSpec", "ProfileSpec"]
__version__ = "0.1.0"
