"""Join, dedupe, ranking and key operators shared by the ledger plans."""
