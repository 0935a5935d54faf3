"""Landing, scanning, ledger and load verbs (bronze and staging layers)."""
