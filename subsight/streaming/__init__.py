"""Incremental execution of the append-only steps with Structured
Streaming. The source has no streaming queries of its own; this runs the
silver reading-log transform (Q3) over new bronze files only."""
