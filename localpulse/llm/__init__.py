"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries with the driver contract at the top of the repository.
"""
