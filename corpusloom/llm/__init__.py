"""Operators for training text: defective pairs, token budgets, similarity groups, packing, mixing and subjects.

Nothing outside this package imports it.
"""
