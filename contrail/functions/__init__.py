"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from contrail.functions.columns import *  # noqa: F401,F403
