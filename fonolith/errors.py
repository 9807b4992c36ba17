"""Errors of the pipelines."""


class PipelineError(Exception):
    """The input can't be processed, or leaves nothing to put out."""
