"""Training-data operators: quality rules, deduplication, decontamination,
pseudonyms, token files, packing and resharding, each as Spark jobs.

Nothing else in the library imports this package. Every operator selects the
columns it needs by name first, so extra columns of the input never clash with
the operator's own columns.
"""
