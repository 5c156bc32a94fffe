"""contrail: flight-delay analytics expressed as Spark DataFrame / SQL /
Structured Streaming jobs.

Every public operator is a plain ``DataFrame -> DataFrame`` function whose
thresholds, windows and ``as_of`` instants are keyword arguments, so the whole
library composes into Catalyst plans without driver-side loops.
"""

from contrail.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
