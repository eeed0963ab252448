"""The one error type raised for a bad load definition."""


class LoadError(ValueError):
    """A load was described in a way that cannot be carried out."""
