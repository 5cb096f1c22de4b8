"""Structured Streaming jobs over the batch operators.

A micro-batch runs the same DataFrame operators as a batch job and writes its
output under its batch id, so a repeated batch replaces its first attempt.
"""
