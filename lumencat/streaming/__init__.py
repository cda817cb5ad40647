"""The row-wise operators and the step statistics on streams."""
