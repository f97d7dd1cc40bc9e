"""Operators of a training-data pipeline (one module per operator).

Nothing else in the package imports this subpackage; the registered queries
are in :mod:`blotter.llm.queries`, their DuckDB twins in
:mod:`blotter.llm.oracle`."""
