"""Operators put together: the stages of a run and the checked queries."""
