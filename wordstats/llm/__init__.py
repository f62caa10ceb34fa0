"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this subpackage; general helpers
(storing an intermediate, scratch folders) are imported from it outwards.
"""
