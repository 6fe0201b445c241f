"""Treatment-pattern analytics over large purchase logs, written for Spark."""
