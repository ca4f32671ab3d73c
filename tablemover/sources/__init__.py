"""Inputs: manifests (files), catalog inventories (listings), table statistics (scans)."""
