"""The operators: hourly counts, daily top lists, scores and repository details."""
