"""The named datasets of the ledger domain, composed from operators, and their fixed dictionaries."""
