"""The classic programs end to end, over files in their known formats."""
