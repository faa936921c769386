"""Named queries (batch and streaming) and their SQL oracles."""
