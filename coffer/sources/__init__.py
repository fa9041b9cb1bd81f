"""Inputs and outputs: sheets, zones, ledger tables."""
