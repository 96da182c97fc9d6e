"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from quern.shipping import ship_package

ship_package()
