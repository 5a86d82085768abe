"""DataFrame operators: checks, samples, patterns, series and forecasts."""
