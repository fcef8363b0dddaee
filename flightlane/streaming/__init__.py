"""Landing keyed messages, in batch and as a stream."""
