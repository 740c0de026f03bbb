"""Operators of a training-data pipeline over text tables: one module per
operator, their driver queries in :mod:`assay.llm.queries`."""
