"""Training-data pipeline operators: one module per operator, plus the query
catalog. Nothing else in the library imports this subpackage."""
