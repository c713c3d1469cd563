"""Seismic-event analytics on Spark: ingest, merge, model, serve, check.

Every public function takes and returns DataFrames; dates and run stamps are
explicit parameters (see :class:`epicentre.params.RunParams`).
"""

__version__ = "0.1.0"
