"""Named query plans: each pairs a Spark DataFrame plan with its SQL oracle."""

from . import changes_q, derived_q, ingest_q, reads_q  # noqa: F401  (register queries)
from .registry import ORACLE, QUERIES, run, tables_for  # noqa: F401
