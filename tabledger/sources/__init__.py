"""Readers and writers: mapping files, listings, snapshots and the ledger."""
