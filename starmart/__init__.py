"""starmart — order-line analytics on Spark DataFrames.

Layers:
    sources/    readers (CSV landing feed, Parquet tables, fixture adapter)
    functions/  Column -> Column helpers (dates, keys, numeric traps)
    operators/  DataFrame -> DataFrame operators (staging, marts, quality,
                measures, evaluation, modeling, sync, runs)
    plans/      end-to-end jobs and the query catalogue
    streaming/  Structured Streaming form of the landing step
"""

from starmart.session import get_spark

__all__ = ["get_spark"]
__version__ = "0.1.0"
