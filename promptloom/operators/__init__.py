"""DataFrame operators. They take and return DataFrames; only those documented as such run a job early."""
