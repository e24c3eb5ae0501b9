"""Operators put together: the stages of the pipeline and the registered queries."""
