"""DataFrame -> DataFrame operators (batch views, windows, merge, monitoring)."""
