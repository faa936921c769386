"""Column-level helpers (JSON access, timestamps, money)."""
