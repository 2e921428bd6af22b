"""quire: text indexing, ranking and retrieval evaluation as Spark DataFrame jobs.

Layout
------
functions/  column-level building blocks (analyzers, hashes, length encodings)
sources/    readers for collections, judgements, file trees, stop words, runs; sinks
operators/  index build, ranking models, evaluation, tuning, significance, hygiene
plans/      end-to-end jobs composed from operators, and the query registry
streaming/  incremental (availableNow) upsert of a document index
"""

from quire.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
