"""Column expressions (no data access): flags, digests, encodings, text."""

from keysieve.functions import charclass, digest, sequence, text  # noqa: F401
