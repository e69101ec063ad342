"""Structured Streaming jobs (L1-L4): availableNow + checkpoints, watermark
dedup and late-data handling, partition-scoped foreachBatch MERGE."""
