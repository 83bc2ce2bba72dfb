"""Join strategies and the composed jobs."""
