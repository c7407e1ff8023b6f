"""Operators of a training-data pipeline: text in, decisions, spans, ids and sequences out."""
