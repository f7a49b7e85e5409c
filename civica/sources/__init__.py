"""Sources and sinks.

lake        delimited files in any Hadoop path: reads (decimal commas, repeated
            or blank headers, ragged lines), folder ingest, CSV/Parquet writes,
            routed loads, deletes (S1-S4, K1, K4-K6, K9)
warehouse   catalog tables in shared storage: scans, append/replace, schema,
            listing, truncation (S5-S8, S10, K2, K3, K7, K8)
literal     small typed tables written in code (S9)
"""
