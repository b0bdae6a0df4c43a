"""DataFrame-to-DataFrame jobs: lazy, no action inside unless documented."""
