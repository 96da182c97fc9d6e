"""Makes this package's functions usable on executors that do not have it installed."""

import sys

from pyspark import cloudpickle


def ship_package() -> None:
    """Pickle functions of this package by value, so a job needs no installation on the executors."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
