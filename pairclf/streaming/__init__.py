"""The line totals as a stream."""
