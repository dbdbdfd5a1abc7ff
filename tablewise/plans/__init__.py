"""End-to-end plans.

jobs        J1-J4 reports and run parameters
run         spark-submit entry point writing all sinks
queries     the registered driver queries (with their DuckDB oracle text)
oracle_sql  DuckDB text builders for the oracles
"""
