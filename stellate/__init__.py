"""stellate: profiling, star-schema building and metrics as Spark DataFrame plans."""

from stellate.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
