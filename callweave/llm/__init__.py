"""Operators for the preparation of training text. Nothing outside this folder imports it."""
