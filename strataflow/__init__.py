"""Metadata-driven bronze / silver / gold processing on plain Spark.

Every operator is a function from DataFrame to DataFrame that can be used on its
own; ``strataflow.plans`` composes them from one JSON document.
"""

from strataflow.plans.config import load_document
from strataflow.plans.pipeline import Pipeline

__all__ = ["Pipeline", "load_document"]
