"""pricelab: product-price analytics as Spark DataFrame jobs.

Layout
------
functions/  column-expression builders (text features, errors, losses)
operators/  DataFrame -> DataFrame operators (metrics, quantiles, windows, TF-IDF, ...)
sources/    readers, writers and derived inputs (catalog, prediction store, manifest)
plans/      end-to-end jobs (feature pipeline, model jobs, ensemble, submission, ingest)
streaming/  the same stateless feature expressions on a streaming DataFrame
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python functions of this package that run on executors (the Arrow UDF, mapInPandas functions)
    are pickled by value, so workers need no installed copy of the package."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be importable on workers
        pass


_ship_by_value()
