"""Lossless audit-event archive, verification and reporting on Spark DataFrames."""
