"""Plan-level building blocks: work folder, size checks, ordered work on long calls."""
