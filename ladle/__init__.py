"""ladle: recipe-driven data preparation and protection on Spark.

Everything is a DataFrame.  A recipe is an ordered list of steps; each
step is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so a whole recipe becomes one lazy logical plan that
Catalyst optimises (column pruning and filter pushdown reach the scan).
"""

from ladle.plans.recipe import Recipe, Step, apply_recipe, parse_recipe, step  # noqa: F401
from ladle.session import build_session, scratch_dir  # noqa: F401

__all__ = ["Recipe", "Step", "apply_recipe", "parse_recipe", "step", "build_session", "scratch_dir"]
