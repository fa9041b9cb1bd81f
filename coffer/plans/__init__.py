"""Ledger plans: cleaning, staging, loading, views, marts, reports, checks."""
