"""Operators of a training-data pipeline.

One module per operator; ``catalog`` registers a query for each. Nothing outside
this folder imports it.
"""
