"""The claims pipeline: raw rows to typed rows, to one canonical state, to marts."""
