"""Set-based operators over register tables, layers and pixels."""
