"""Which months to run, their state, and the jobs that ingest and maintain them."""
