"""pagelake: typed tables from stored learning-platform responses, on Spark.

Layout:
    sources/    S1–S5 readers, adapters and sinks
    functions/  column functions (DOM selectors, text, URLs, dates, JSON)
    operators/  D1 shredder, page extractors, row logic (first/last wins,
                paging, pseudonyms), joins, quality and redaction
    plans/      named queries over the driver tables and their SQL oracles
    streaming/  rate admission and incremental extraction
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions *by value* so Python stages (the shredder,
    grouped-map operators) run on executors that do not have it installed."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except ValueError:
        pass  # already registered


_ship_by_value()
