"""pulse: social-content analytics (normalise, deduplicate, label, report) on Spark.

See README.md for the layout; ``pulse.plans.catalogue`` lists one query per
operator group, ``pulse.plans.jobs`` the batch cycles and ``pulse.streaming``
the streaming jobs.
"""

__version__ = "0.1.0"
