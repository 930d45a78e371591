"""ratescope: a Spark-native engine for hospital price-transparency data.

Everything is a lazy DataFrame builder: DataFrames and a :class:`PipelineConfig` in, a DataFrame out.
Spark owns parsing, planning, shuffles and storage.
"""

from ratescope.config import PipelineConfig

__all__ = ["PipelineConfig"]
