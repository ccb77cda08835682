"""Operators for preparing training data; see ``registry`` for their queries."""
