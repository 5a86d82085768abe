"""Workflows over the operators: generate, execute, maintain, report."""
