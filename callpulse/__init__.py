"""callpulse: point-in-time customer-contact features, scoring and alerts on Spark.

Every step is a DataFrame -> DataFrame transform (``callpulse.operators``),
fed by table readers (``callpulse.sources``) and composed into the three
batch jobs train / score / alerts (``callpulse.plans.jobs``).
"""

from callpulse.config import Config

__all__ = ["Config"]
