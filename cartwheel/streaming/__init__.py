"""Structured Streaming: sinks, keyed funnel state, and the jobs P1-P5."""
