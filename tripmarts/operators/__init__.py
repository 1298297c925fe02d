"""DataFrame-to-DataFrame steps: no reading, no writing, no actions."""
