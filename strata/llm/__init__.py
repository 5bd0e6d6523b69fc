"""Operators of a training-data pipeline on the tables documents, embeddings and pages.

One module per operator; :mod:`strata.llm.queries` registers one query for each.
Nothing outside this subpackage imports it.
"""
