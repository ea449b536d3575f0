"""Repository trends from public code-hosting event archives, as Spark jobs."""
