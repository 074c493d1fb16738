"""Column -> Column scalar functions (all JVM-side expressions, no Python UDFs)."""

from pullscope.functions.scalars import *  # noqa: F401,F403
from pullscope.functions.mathx import erfc, chi2_sf_1df, normal_sf  # noqa: F401
