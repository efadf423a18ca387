"""DataFrame operators: f(df, ..., options) -> DataFrame, lazy."""
