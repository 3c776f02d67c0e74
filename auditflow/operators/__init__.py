"""DataFrame-to-DataFrame operators, usable in batch and inside a micro-batch."""
