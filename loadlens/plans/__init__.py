"""Plans made of several operators: run summaries, projections, galleries, request generation."""
