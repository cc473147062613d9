"""DataFrame operators shared by the composed jobs."""
