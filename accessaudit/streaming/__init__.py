"""The micro-batch audit job."""
