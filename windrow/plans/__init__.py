"""Operators composed into the layers of the batch job."""
