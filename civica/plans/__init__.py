"""Query plans.

registry    the @query registry (builder + DuckDB oracle SQL per key)
carriers    election roles mapped onto the test tables, with SQL twins
q_tables, q_io, q_joins, q_aggregates, q_models
            the catalogue, one module per theme
catalogue   queries() / oracle_sql() over the registry
elections   the reference's jobs end to end (load, model, shares, history,
            right vote vs crime)
"""
