"""ridgeline: supervised modelling on tables, written as Spark jobs.

Every row-sized step (scan, clean, profile, split, moments, gradients,
scoring, evaluation) is a DataFrame job; the driver only ever holds
coefficient-sized arrays (feature moments, weights, per-partition counts).
"""

__version__ = "0.1.0"


def _ship_by_value():
    """Executors need not have this package installed: functions and classes of
    ``ridgeline`` used inside Arrow kernels are pickled by value."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001  (older cloudpickle: rely on an installed package)
        pass


_ship_by_value()
