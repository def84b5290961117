"""Verification workloads: the operators run over the driver's star-schema
tables, each paired with an independent DuckDB SQL formulation."""
