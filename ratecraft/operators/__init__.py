"""DataFrame operators: joins, aggregates, ordered scans, profiles, features, trials,
models and attribution. Each is a function (or a small fitted object) over Spark
DataFrames; see README.md for the map from survey IDs to functions."""
