"""Operators for preparing training text at scale, each by the method its module names."""
