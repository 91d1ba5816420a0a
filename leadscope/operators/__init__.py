"""The jobs: DataFrame(s) -> DataFrame, planned end to end by Catalyst."""
