"""Column functions: canonical forms, digests, protection, redaction."""
