"""Typed, checked tables from large XML result files, on Spark."""

import sys

from pyspark import cloudpickle

from tagloom.errors import IngestError
from tagloom.plans.ingest import Source, ingest, read_table
from tagloom.plans.profile import profile
from tagloom.spec import Field, Registry, TableSpec, default_registry
from tagloom.streaming.compact import compact
from tagloom.streaming.ingest import ingest_stream

__all__ = [
    "Field",
    "IngestError",
    "Registry",
    "Source",
    "TableSpec",
    "compact",
    "default_registry",
    "ingest",
    "ingest_stream",
    "profile",
    "read_table",
]

# The few functions that run in Python workers travel with the job, so that the
# package needs no installation on the nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
