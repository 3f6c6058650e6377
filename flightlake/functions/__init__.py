"""Column expressions: everything here is a built-in Spark expression (codegen, no Python per row)."""

from flightlake.functions.scalar import *  # noqa: F401,F403
