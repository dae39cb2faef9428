"""Job plans: the batch job, serving helpers and the query catalog."""
