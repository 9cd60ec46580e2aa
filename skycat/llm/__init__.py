"""Operators for training-data pipelines: documents and pages in, decisions and digests out.

Nothing else in the library imports this subpackage.
"""
