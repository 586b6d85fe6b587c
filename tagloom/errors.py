class IngestError(Exception):
    """Raised for unusable arguments, unreadable sources and failed checks."""
