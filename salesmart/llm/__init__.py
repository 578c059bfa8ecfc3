"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query for each numbered operator and, where SQL can express it, its twin.
"""
