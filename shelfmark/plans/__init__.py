"""The jobs: staging tables, star schema, incremental extract and the daily run."""
