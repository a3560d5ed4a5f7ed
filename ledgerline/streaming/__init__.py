"""Structured Streaming operators: continuous skip-if-held ingestion by key buckets, count-triggered batch
flushing with counters per run and epoch, and live progress counts."""
