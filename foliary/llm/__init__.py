"""Operators for preparing very large text corpora, one module each.

Nothing outside this subpackage imports it.
"""
