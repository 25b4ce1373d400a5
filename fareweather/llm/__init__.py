"""Operations of a training-data pipeline, each over whole tables.

Functions of this package are sent to Python workers by value, so executors need no copy of it.
"""

from pyspark import cloudpickle

from . import chat, common, components, html_text, jaccard_join, merkle, mixing, multi_index, packing, quality_fm, repair, repeats, secret_scan, toxicity, vector_dedup, vectors, words

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["common"]))

_MODULES = (secret_scan, chat, html_text, multi_index, mixing, vector_dedup, jaccard_join, quality_fm, packing, toxicity, merkle, repeats, repair)


def queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLES", {}).items()}
