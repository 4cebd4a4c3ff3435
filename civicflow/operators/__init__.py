"""DataFrame-to-DataFrame operators without input or output."""
