"""Compositions of jobs, the registered queries and their SQL counterparts."""
