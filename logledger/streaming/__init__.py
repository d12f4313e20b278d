"""Incremental forms of the batch reports over growing log folders."""
