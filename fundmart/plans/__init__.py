"""Plans made of the operators: delivery checks, star tables, indicators, reports, jobs."""
