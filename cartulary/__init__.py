"""Cataloguing, harmonising, validating, splitting and reporting on pooled datasets with Spark DataFrames."""
