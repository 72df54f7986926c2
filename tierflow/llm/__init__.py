"""Operators for preparing training text: one module per operator, their
registered queries in :mod:`tierflow.llm.registry`."""
