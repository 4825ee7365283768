"""The same transforms as checkpointed Structured Streaming jobs."""
