"""Scoring pipelines and the operators they are made of."""
