"""Inputs and outputs: fixture derivations from the driver tables, wide-sheet
and snapshot-feed scans, and table / file sinks."""
