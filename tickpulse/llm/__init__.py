"""Operators for preparing language-model training text (ten operators and a pipeline).

Nothing outside this subpackage imports it; ``queries`` registers its queries.
"""
