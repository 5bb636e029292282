"""Registered queries, grouped by the driver tables they read."""

from parley.plans.families import cascade_q, classify_q, documents, inputs_q, metrics_q, retrieval_q, scoring, splits, streams_q, tables_q, threads  # noqa: F401
