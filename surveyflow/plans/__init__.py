"""Compositions of the operators: stages, report datasets, the end-to-end run and the registered queries."""
