"""The operators run over the driver's tables, each with its SQL counterpart."""

from proofmark.plans import intake, kept, quality, runs, selections, snapshots, starts, state, streams, verification, workloads  # noqa: F401
from proofmark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
