"""DataFrame-to-DataFrame operators; batch jobs and streams use the same ones."""
