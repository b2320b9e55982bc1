"""textlab: labelled-text analytics on Spark DataFrames.

Subpackages
-----------
sources    readers, contract checks, fixture views over the provided tables, sinks
functions  ``Column`` functions (rating parse, labels, cleaning, tokens, stop words)
operators  DataFrame -> DataFrame operators (profiling, splits, features,
           scoring, evaluation, quality gate, distributed prefix sums)
plans      end-to-end jobs (clean, train with fold-shared CV, evaluate) and the
           registered query catalogue
streaming  Structured Streaming ingest, scoring and running summaries
"""

from textlab.config import LabelConfig, SplitConfig, TrainConfig

__all__ = ["LabelConfig", "SplitConfig", "TrainConfig"]
