"""Operators for preparing training text at scale.

One module for each operator; ``queries`` registers the thin query of each.
Nothing outside this folder imports it.
"""
