"""DataFrame -> DataFrame operators; unless noted they work on batch and on streaming input."""
