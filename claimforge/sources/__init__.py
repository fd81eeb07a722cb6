"""Reading raw extracts with their lineage, and writing exports."""
