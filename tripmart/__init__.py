"""Tripmart: layered ride-trip tables on Spark.

raw trips -> curated (typed, enriched, validated) -> three daily marts,
as a full rebuild, a one-month refresh or an incremental stream.
"""

from tripmart.session import prepare, work_dir  # noqa: F401
