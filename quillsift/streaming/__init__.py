"""Loading file by file: a ledger in batch form, and Structured Streaming."""
