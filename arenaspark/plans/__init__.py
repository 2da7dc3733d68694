"""Bindings of the operators to concrete tables, and the registered queries."""
