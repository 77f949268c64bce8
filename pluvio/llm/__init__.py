"""Operators of a training-data pipeline (classifier, rules, dedup, extraction, packing).

Nothing else in the package imports this subpackage. The registered queries are
in ``queries``; each operator has a module of its own.
"""
