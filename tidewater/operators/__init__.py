"""DataFrame-to-DataFrame operators; each accepts batch input and, where Spark allows, a stream."""
