"""Operators that prepare training text: dedup, fingerprints, tokens, packing, archives.

Nothing outside this subpackage imports it.
"""
