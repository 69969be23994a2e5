"""Column-expression builders (metrics, scoring, array helpers)."""

from __future__ import annotations

import functools


def column_cache(fn):
    """Memoize a builder of (tuples of) Columns per live SparkContext.

    Column expressions are immutable and unresolved, so one instance can be
    used by any number of DataFrames; caching avoids rebuilding the same
    expression tree through the JVM gateway for every query.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext

        sc = SparkContext._active_spark_context
        app = getattr(sc, "_ls_app_id", None)
        if app is None and sc is not None:
            app = sc._ls_app_id = sc.applicationId
        key = (app, args)
        hit = cache.get(key)
        if hit is None:
            hit = cache[key] = fn(*args)
        return hit

    return wrapper
