"""Operators for training-text pipelines. Nothing outside this folder imports it."""
