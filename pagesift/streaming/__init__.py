"""Incremental runs over newly landed records or manifests (``incremental``)."""
