"""Command-line jobs, one per application: run with ``python -m reelrank.jobs.<name>``."""
