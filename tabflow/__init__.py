"""Tabflow: batch analytics pipelines written as plain PySpark DataFrame functions.

Layout
------
- ``tabflow.sources``    import with schema detection and type overrides, scans
- ``tabflow.functions``  column expressions (rounding, ratios, labels, formatting)
- ``tabflow.operators``  relational building blocks, data-quality checks,
                         staging / write-audit-publish sinks, exact quantiles
- ``tabflow.plans``      the data products: conversion by segment, pickup
                         location statistics and their reports, engagement
                         segments, the import flow
- ``tabflow.streaming``  intentionally empty (no streaming semantics to match)

Every function takes and returns ``DataFrame`` objects and never collects data
to the driver, so Catalyst plans each pipeline end to end.
"""

__version__ = "0.1.0"
