"""DataFrame operators: conforming, joining, keying, aggregating, auditing."""
