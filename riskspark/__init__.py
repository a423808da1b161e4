"""Credit-risk analytics as PySpark DataFrame operators."""

from riskspark.spec import SampleSpec, SplitSpec

__all__ = ["SampleSpec", "SplitSpec"]
