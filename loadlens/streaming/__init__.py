"""The same operators on unbounded input: Structured Streaming sources, state and sinks."""
